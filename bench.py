"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs once to warm
up and ``BENCH_RUNS`` times for the measurement (the median counts); its rows are written to the
``noop`` sink, so all columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from delaywright.plans import all_queries
from delaywright.runtime import local_session

HEADLINE = [
    "delay_ratio_by_group",
    "summary_by_group",
    "share_within_group",
    "pivot_daily_by_year",
    "dedupe_keys",
    "win_parallel_exact",
    "win_parallel_15min",
    "win_last_known_delay",
    "win_tail_sequence",
    "win_prior_delay",
    "feature_table",
    "asof_join_prior_event",
    "flight_weather_join",
    "nearest_neighbor_lookup",
    "profile_null_pct",
    "quartile_shares",
    "five_number_summary",
    "corr_pearson_pairs",
    "corr_spearman_pairs",
    "split_chrono",
    "split_report",
    "cv_sliding_bounds",
    "interval_classify",
    "sweep_sigma_multiplier",
    "metric_auc",
    "graph_node_count",
    "topk_out_degree",
    "graph_init",
    "pagerank",
    "ml_linear_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES")
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")
    conf = {"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": shared}
    spark = local_session(cores, cores, **conf)
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    seconds: dict[str, float] = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        taken = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
