"""Graph goldens: an 11-node test graph, a five-node walk, invariants on random graphs."""

import random

import pytest
from pyspark.sql import functions as F

from delaywright.operators import graph
from delaywright.operators.delay_rank import rolling_airport_ranks
from delaywright.sources import adjacency
from tests.conftest import rows_of

# The test graph as adjacency text and its published ranks after 20 steps.
TEST_GRAPH = """\
2\t{'3': 1}
3\t{'2': 2}
4\t{'1': 1, '2': 1}
5\t{'4': 3, '2': 1, '6': 1}
6\t{'2': 1, '5': 2}
7\t{'2': 1, '5': 1}
8\t{'2': 1, '5': 1}
9\t{'2': 1, '5': 1}
10\t{'5': 1}
11\t{'5': 2}"""
TEST_RANKS = {
    1: 0.04255740809817991,
    2: 0.3620640495978871,
    3: 0.333992700474142,
    4: 0.06030963508473455,
    5: 0.08506399429624555,
    6: 0.03138662354831139,
    7: 0.01692511778009981,
    8: 0.01692511778009981,
    9: 0.01692511778009981,
    10: 0.01692511778009981,
    11: 0.01692511778009981,
}
FIVE_NODES = "AB AD BC BE CD DE EA EB EC".split()
FIVE_STEADY = [0.10526316, 0.15789474, 0.18421053, 0.23684211, 0.31578947]
LEAKING = "AB AC AD BD BE CA CE DB".split()


@pytest.fixture(scope="module")
def test_graph(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("graph") / "test_graph.txt"
    path.write_text(TEST_GRAPH + "\n")
    return adjacency.read_adjacency(spark, str(path), numeric_ids=True).cache()


def letters(spark, pairs):
    return spark.createDataFrame([(p[0], p[1], 1) for p in pairs], "src string, dst string, weight bigint")


def test_published_ranks(test_graph):
    ranks = dict(graph.pagerank(test_graph, iterations=20).collect())
    assert ranks == pytest.approx(TEST_RANKS, abs=1e-12)


def test_ranks_do_not_depend_on_salting(test_graph):
    salted = graph.pagerank(test_graph, iterations=20, edges_per_task=1, cut_every=3)
    assert dict(salted.collect()) == pytest.approx(TEST_RANKS, abs=1e-12)


def test_degree_statistics(test_graph):
    assert graph.node_count(test_graph).first()["nodes"] == 11
    assert graph.average_out_degree(test_graph).first()[0] == pytest.approx(2.2)
    assert graph.top_out_degree(test_graph, 2).collect()[0]["id"] == 5
    assert rows_of(graph.dangling_nodes(test_graph)) == [(1,)]
    ratio = graph.dangling_ratio(test_graph).first()
    assert (ratio["regular"], ratio["dangling"]) == (10, 1)
    assert rows_of(graph.lookup_node(test_graph, 5)) == [(3, 5)]


def test_init_has_every_node(test_graph):
    records = graph.init_graph(test_graph).collect()
    assert len(records) == 11
    assert all(r["rank"] == pytest.approx(1 / 11) for r in records)
    assert {r["id"]: r["out_degree"] for r in records}[1] == 0


def test_zero_iterations_is_the_start(test_graph):
    assert {r["pagerank"] for r in graph.pagerank(test_graph, iterations=0).collect()} == {1 / 11}


def brute_pagerank(edges, alpha, steps):
    nodes = sorted({n for s, d, _ in edges for n in (s, d)})
    out = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(steps):
        mass = sum(rank[n] for n in nodes if out[n] == 0)
        inflow = dict.fromkeys(nodes, 0.0)
        for s, d, w in edges:
            inflow[d] += rank[s] * w / out[s]
        rank = {n: alpha / len(nodes) + (1 - alpha) * (mass / len(nodes) + inflow[n]) for n in nodes}
    return rank


@pytest.mark.parametrize("seed,edges_per_task", [(0, 4), (1, 10_000)])
def test_random_graphs(spark, seed, edges_per_task):
    source = random.Random(seed)
    pairs = {}
    for _ in range(200):
        s = 0 if source.random() < 0.33 else source.randrange(40)
        d = 1 if source.random() < 0.33 else source.randrange(50)
        pairs[s, d] = pairs.get((s, d), 0) + 1
    edges = [(s, d, w) for (s, d), w in pairs.items()]
    df = spark.createDataFrame(edges, "src int, dst int, weight bigint")
    ranks = graph.pagerank(df, iterations=7, edges_per_task=edges_per_task)
    assert dict(ranks.collect()) == pytest.approx(brute_pagerank(edges, 0.15, 7), abs=1e-12)
    assert graph.total_mass(ranks).first()["total_mass"] == pytest.approx(1.0, abs=1e-9)


def test_unweighted_and_unnormalised(spark):
    df = spark.createDataFrame([(1, 2, 9), (1, 3, 1), (2, 1, 1)], "src int, dst int, weight bigint")
    ranks = dict(graph.pagerank(df, weighted=False, normalise=False).collect())
    assert ranks[2] == pytest.approx(ranks[3])
    assert sum(ranks.values()) == pytest.approx(3.0)


def test_steady_state(spark):
    state = dict(graph.steady_state(letters(spark, FIVE_NODES), 60, start="A").collect())
    assert [state[n] for n in "ABCDE"] == pytest.approx(FIVE_STEADY, abs=1e-6)


def test_undamped_walk_leaks_at_dangling_nodes(spark):
    state = graph.steady_state(letters(spark, LEAKING), 12, start="A")
    assert state.agg(F.sum("probability")).first()[0] < 0.2


def test_transition_probability(spark):
    probabilities = graph.transition_probabilities(letters(spark, FIVE_NODES))
    assert probabilities.filter("src = 'E' and dst = 'C'").first()["p"] == pytest.approx(1 / 3)


def test_matrix_and_list_keep_nodes_without_links(spark):
    edges = letters(spark, LEAKING)
    matrix = {r["node"]: list(r[1:]) for r in graph.adjacency_matrix(edges, list("ABCDE")).collect()}
    assert matrix["A"] == [0, 1, 1, 1, 0] and matrix["E"] == [0] * 5
    lists = {r["id"]: r["neighbours"] for r in graph.adjacency_list(edges).collect()}
    assert lists["B"] == ["D", "E"] and lists["E"] == []
    parts = graph.adjacency_list(edges, per_record=1).filter("id = 'A'").collect()
    assert sorted(r["part"] for r in parts) == list(range(len(parts)))
    assert {(r["i"], r["j"]) for r in graph.adjacency_entries(edges).collect()} == {(r["src"], r["dst"]) for r in edges.collect()}
    with pytest.raises(ValueError, match="outside"):
        graph.adjacency_matrix(edges, ["A"])
    assert sorted(n for r in parts for n in r["neighbours"]) == ["B", "C", "D"]


def test_adjacency_text_round_trip(spark, tmp_path, test_graph):
    path = adjacency.write_adjacency(test_graph, str(tmp_path / "edges"))
    assert rows_of(adjacency.read_adjacency(spark, path, True)) == rows_of(test_graph)


def test_long_lists_are_split_over_lines(test_graph):
    lines = adjacency.adjacency_lines(test_graph, edges_per_line=2)
    assert lines.count() > test_graph.select("src").distinct().count()
    back = adjacency.explode_edges(adjacency.parse_lines(lines))
    assert back.count() == test_graph.count()


def test_text_is_parsed_not_evaluated(spark):
    lines = spark.createDataFrame([("7\t__import__('os').getcwd()",), ("8\t{'1': 2}",)], "value string")
    assert rows_of(adjacency.explode_edges(adjacency.parse_lines(lines))) == [("8", "1", 2)]


def test_expand_multiplicity(spark):
    lines = spark.createDataFrame([("3\t{'2': 2, '1': 1}",), ("4\t{}",)], "value string")
    assert rows_of(adjacency.expand_multiplicity(adjacency.parse_lines(lines))) == [("3", 0, "1,2,2"), ("4", 0, "")]


@pytest.mark.parametrize("rows_per_task", [4, 5_000_000])
def test_expanded_links_come_in_bounded_parts(spark, rows_per_task):
    """Whatever the records' layout, and however heavy a link or busy a node."""
    weights = {f"{i:02d}": 1 + i % 3 for i in range(25)} | {"07": 40}
    edges = spark.createDataFrame([("n", d, w) for d, w in weights.items()] + [("m", "x", 3)], "src string, dst string, weight bigint")
    every = [d for d in sorted(weights) for _ in range(weights[d])]
    expected = sorted(("n", p, ",".join(every[7 * p : 7 * p + 7])) for p in range(-(-len(every) // 7)))
    for size in (100, 10):
        records = adjacency.parse_lines(adjacency.adjacency_lines(edges, size))
        found = rows_of(adjacency.expand_multiplicity(records, 7, rows_per_task), "node", "part", "outlinks")
        assert sorted(found) == sorted([("m", 0, "x,x,x"), *expected])


def test_the_callers_cache_stays(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 2)], "src string, dst string, weight bigint").persist()
    graph.pagerank(edges, iterations=2).collect()
    graph.steady_state(edges, 2).collect()
    assert edges.storageLevel.useMemory
    edges.unpersist()
    other = spark.createDataFrame([("a", "c", 1)], "src string, dst string, weight bigint")
    graph.pagerank(other, iterations=2).collect()
    assert not other.storageLevel.useMemory


def test_rank_slice(spark):
    ranks = spark.createDataFrame([(i, 1.0 / (i + 1)) for i in range(50)], "id int, pagerank double")
    assert [r["id"] for r in graph.rank_slice(ranks, 20, 40).collect()] == list(range(20, 40))


def test_ranks_of_many_graphs_at_once_equal_each_alone(spark):
    """Graphs of different sizes, with and without dangling nodes, some sharing nodes."""
    draw = random.Random(12)
    rows = []
    for g in range(5):
        nodes = [f"n{i}" for i in range(3 + 2 * g)]
        rows += [(g if g else None, draw.choice(nodes), draw.choice(nodes), draw.randint(1, 9)) for _ in range(4 * len(nodes))]
    edges = spark.createDataFrame(rows, "g int, src string, dst string, weight bigint").groupBy("g", "src", "dst").agg(F.sum("weight").alias("weight"))
    # every graph in a task, every graph walked, and some of each
    found, walked, mixed = (
        {(r["g"], r["id"]): r["pagerank"] for r in graph.pagerank_by(edges, "g", iterations=7, edges_per_task=5, edges_per_graph=n).collect()}
        for n in (1000, 0, 20)
    )
    expected = {}
    for g in {r[0] for r in rows}:
        own = edges.filter(F.col("g").eqNullSafe(F.lit(g))).drop("g")
        expected |= {(g, r["id"]): r["pagerank"] for r in graph.pagerank(own, iterations=7).collect()}
    assert found.keys() == expected.keys()
    for ranks in (found, walked, mixed):
        assert ranks.keys() == expected.keys()
        assert all(ranks[k] == pytest.approx(expected[k], abs=1e-12) for k in ranks)
    assert sum(found.values()) == pytest.approx(5)


def test_rolling_ranks_use_only_the_days_before(spark):
    rows = [(1, "2024-01-01", "A", "B", 5.0), (2, "2024-01-03", "B", "C", 7.0), (3, "2024-01-04", "C", "A", 2.0), (4, "2024-01-06", "A", "C", -1.0), (5, None, "A", "C", 9.0)]
    df = spark.createDataFrame(rows, "id int, d string, o string, e string, late double").withColumn("d", F.to_date("d"))
    found = rolling_airport_ranks(df, "d", "o", "e", "late", days=2)
    by_day = {}
    for r in found.collect():
        by_day.setdefault(str(r["d"]), {})[r["id"]] = r["pagerank"]
    assert {day: set(ranks) for day, ranks in by_day.items()} == {"2024-01-03": {"A", "B"}, "2024-01-04": {"B", "C"}, "2024-01-06": {"C", "A"}}
    assert all(sum(ranks.values()) == pytest.approx(1) for ranks in by_day.values())
