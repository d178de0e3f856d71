"""What the plans must and must not contain."""

import re

import pytest

from delaywright import runtime
from delaywright.plans import all_queries
from tests.conftest import SMALL, plan_text

QUERIES = all_queries()
# fitting a model is no plan property; these are checked elsewhere
PLANNED = sorted(n for n in QUERIES if not n.startswith(("ml_", "tune_", "cv_random", "model_", "run_log")))


_PLANS = {}


def plan_of(spark, name):
    if name not in _PLANS:
        _PLANS[name] = plan_text(QUERIES[name](spark, SMALL))
    return _PLANS[name]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_rows_and_no_cross_join(spark, name):
    text = plan_of(spark, name)
    for banned in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


@pytest.mark.parametrize("name", PLANNED)
def test_single_task_windows_only_over_bounded_frames(spark, name):
    """A window without keys is allowed over at most ROWS_PER_RANGE distinct values, or classes."""
    single = re.search(
        r"Window[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition|Window[^\n]*\n[^\n]*Exchange SinglePartition",
        plan_of(spark, name),
    )
    bounded = {"metric_by_label", "metric_weighted_pr", "metric_auc"}
    assert (single is not None) == (name in bounded)


def test_scans_read_only_what_is_needed(spark):
    text = plan_text(QUERIES["delay_ratio_by_group"](spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_filters_are_pushed(spark):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan_text(QUERIES["filter_since"](spark, SMALL))
    assert "Or(" not in plan_text(QUERIES["filter_not_cancelled"](spark, SMALL))


def test_topk_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_text(QUERIES["limit_ordered"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan_text(QUERIES["topk_out_degree"](spark, SMALL))


def test_counts_are_combined_before_the_shuffle(spark):
    assert "partial_count" in plan_text(QUERIES["count_by_group"](spark, SMALL))
    assert "partial_sum" in plan_text(QUERIES["out_degree"](spark, SMALL))


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert runtime.shared_root(spark) == configured
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


class FakeSession:
    """A cluster session without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

        @staticmethod
        def getConf():
            return FakeSession.conf


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        runtime.shared_root(FakeSession)


def test_spooled_rows_are_read_back_from_the_shared_folder(spark):
    kept = runtime.spool(spark.range(5), "t")
    assert kept.count() == 5
    assert runtime.shared_root(spark).replace("file:", "") in kept.inputFiles()[0]
