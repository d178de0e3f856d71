"""Steps whose tasks must not grow with the table."""

import random

from pyspark.sql import functions as F

from delaywright.learning import features as ft
from delaywright.learning import search
from delaywright.operators import ranking
from delaywright.operators.skew import ROWS_PER_TASK
from delaywright.plans import training
from delaywright.sources import adjacency
from tests.conftest import SMALL


def test_large_columns_alone_go_into_long_form(spark):
    draw = random.Random(4)
    given = [
        (draw.choice([None, 1.0, 2.0, 3.0]), draw.choice([None, *map(float, range(90))]), draw.choice([5.0, 6.0]))
        for _ in range(300)
    ]
    given += [(1.0, None, 5.0), (None, None, None)]
    rows = spark.createDataFrame(given, "a double, b double, c double")
    columns = [F.col(c) for c in rows.columns]
    ranks = ranking.rank_columns(rows, columns)

    def found(limit):
        kept = ranking.attach_ranks(rows, columns, ranks, broadcast_values=limit)
        assert kept.columns == ["r0", "r1", "r2"]
        listed = [tuple(r) for r in kept.collect() if any(v is not None for v in r)]
        return sorted(listed, key=lambda r: [(v is None, v or 0.0) for v in r]), kept

    whole, _ = found(1_000)
    mixed, plan = found(10)
    assert whole == mixed == found(0)[0]
    # only the large column is gathered back from the long form
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN (t#") == 1


def test_links_are_scanned_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(adjacency, "LINKS_PER_TASK", 50)
    lines = [(f"n{i}", {f"d{j}": 1 + (i + j) % 3 for j in range(6)}) for i in range(100)]
    records = spark.createDataFrame(lines, "node string, neighbours map<string,bigint>")
    parts = adjacency.expand_multiplicity(records, 5)
    assert "Exchange hashpartitioning(src" in parts._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in parts._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in sorted(parts.collect(), key=lambda r: (r["node"], r["part"])):
        got.setdefault(r["node"], []).extend(r["outlinks"].split(","))
    assert got == {n: [d for d in sorted(m) for _ in range(m[d])] for n, m in lines}


def test_a_slice_fits_a_task():
    # five million rows of a feature table take 2 GB where they are sorted
    assert ROWS_PER_TASK <= 1_000_000


def test_perceptron_trials_share_narrow_frames(spark, monkeypatch):
    seen = []

    def trial(width, train_x, test_x, trial):
        seen.append((width, train_x, test_x, train_x.is_cached and test_x.is_cached))
        return {"loss": 0.0}

    monkeypatch.setattr(training, "_perceptron_trial", trial)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    assert training.tune_mlp(spark, SMALL).filter("name = 'loss'").count() == 8 == len(seen)
    width, train_x, test_x, kept = seen[0]
    # what every step of a fit reads is kept, and nothing beside it
    assert kept and train_x.columns == test_x.columns == ["features", "sign_delay"]
    assert width == len(training.TREE_SPEC.categorical) + len(training.TREE_SPEC.numeric) == len(train_x.first()[0])
    assert not train_x.is_cached and len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_steps_of_large_frames_are_few_long_tasks(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert [ft.step_partitions(n, 6) for n in (0, 50_000, 480_000, 2_400_000, 28_800_000)] == [1, 1, 10, 24, 144]
    monkeypatch.setattr(ft, "STEP_ROWS", 5)
    monkeypatch.setattr(ft, "MOST_STEP_ROWS", 20)
    # all rows lie in one of the partitions they come from
    rows = spark.range(4_000).coalesce(1).persist()
    given = ft.cache_for_steps(rows)
    sizes = [r["count"] for r in given.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 200 and max(sizes) <= 2 * min(sizes) and sum(sizes) == given.distinct().count() == 4_000
    # a large frame goes to one trial at a time, as each holds a copy; a small one to several
    assert search.trials_at_once(given) == 1 and search.trials_at_once(given.coalesce(cores)) == 4
    for frame in (rows, given):
        frame.unpersist()
