"""Data-quality profiles and column statistics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from delaywright.operators import cleaning, profiling, ranking
from delaywright.plans.registry import query
from delaywright.plans.views import FLIGHTS, LABELLED, flights, labelled_documents, rounded, sql_rounded, table

DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


@query(
    "profile_null_counts",
    f"WITH {LABELLED} "
    + _union([f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM v_doc" for c in DOC_COLUMNS]),
)
def profile_null_counts(spark, sf_dir):
    return profiling.null_profile(labelled_documents(spark, sf_dir)).select("column", "nulls")


@query(
    "profile_null_pct",
    f"WITH {LABELLED} "
    + _union(
        [
            f"SELECT '{c}' AS \"column\", round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct FROM v_doc"
            for c in DOC_COLUMNS
        ]
    ),
)
def profile_null_pct(spark, sf_dir):
    profile = profiling.null_profile(labelled_documents(spark, sf_dir))
    return profile.select("column", rounded("missing_pct").alias("missing_pct")).orderBy(
        F.desc("missing_pct"), "column"
    )


@query(
    "prune_sparse_columns",
    f"WITH {LABELLED} SELECT doc_id, lang, source, n_chars FROM v_doc",
)
def prune_sparse_columns(spark, sf_dir):
    return profiling.prune_sparse(labelled_documents(spark, sf_dir), 40.0)


def _quartiles(column: str) -> str:
    return (
        f"(SELECT quantile_cont({column}, 0.25) AS a, quantile_cont({column}, 0.5) AS b, "
        f"quantile_cont({column}, 0.75) AS c FROM lineitem)"
    )


@query(
    "quartile_shares",
    _union(
        [
            f"""SELECT '{c}' AS "column", round(count(*) FILTER ({c} <= a) / count(*), 6) AS q1,
            round(count(*) FILTER ({c} > a AND {c} <= b) / count(*), 6) AS q2,
            round(count(*) FILTER ({c} > b AND {c} <= c) / count(*), 6) AS q3
            FROM lineitem, {_quartiles(c)} q"""
            for c in LINE_COLUMNS
        ]
    ),
)
def quartile_shares(spark, sf_dir):
    shares = profiling.quartile_shares(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)
    return shares.select("column", *[rounded(q).alias(q) for q in ("q1", "q2", "q3")])


@query("quartile_shares_approx")
def quartile_shares_approx(spark, sf_dir):
    return profiling.quartile_shares(table(spark, sf_dir, "lineitem"), LINE_COLUMNS, exact=False)


@query(
    "iqr_bounds",
    _union(
        [
            f"""SELECT '{c}' AS "column", round(any_value(a - 1.5 * (c - a)), 6) AS lower_bound,
            round(any_value(c + 1.5 * (c - a)), 6) AS upper_bound,
            count(*) FILTER ({c} >= a - 1.5 * (c - a) AND {c} <= c + 1.5 * (c - a)) AS rows_inside
            FROM lineitem, {_quartiles(c)} q"""
            for c in LINE_COLUMNS
        ]
    ),
)
def iqr_bounds(spark, sf_dir):
    bounds = profiling.iqr_bounds(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)
    return bounds.select(
        "column",
        rounded("lower_bound").alias("lower_bound"),
        rounded("upper_bound").alias("upper_bound"),
        "rows_inside",
    )


@query(
    "iqr_outlier_pct",
    "WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM events) "
    + """SELECT 'value' AS "column", round(count(*) FILTER (value < a - 1.5 * (c - a) OR value > c + 1.5 * (c - a))
      * 100.0 / count(*), 6) AS outlier_pct FROM events, q""",
)
def iqr_outlier_pct(spark, sf_dir):
    found = profiling.outlier_pct(table(spark, sf_dir, "events"), ["value"])
    return found.select("column", rounded("outlier_pct").alias("outlier_pct"))


@query(
    "iqr_outlier_flags",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS c FROM events)
    SELECT event_id, value < a - 1.5 * (c - a) AS value_lower_outlier,
      value > c + 1.5 * (c - a) AS value_upper_outlier FROM events, q""",
)
def iqr_outlier_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return profiling.with_outlier_flags(events, profiling.iqr_fences(events, ["value"])).drop("value")


@query(
    "five_number_summary",
    _union(
        [
            f"""SELECT '{c}' AS "column", round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
            round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3,
            round(max({c}), 6) AS max, count({c}) AS n FROM lineitem"""
            for c in LINE_COLUMNS[:3]
        ]
    ),
)
def five_number_summary(spark, sf_dir):
    summary = profiling.five_numbers(table(spark, sf_dir, "lineitem"), LINE_COLUMNS[:3])
    return summary.select(
        "column", *[rounded(c).alias(c) for c in ("min", "q1", "median", "q3", "max")], "n"
    )


@query(
    "histogram",
    f"""WITH {FLIGHTS}, e AS (SELECT min(dep_delay) AS lo, max(dep_delay) AS hi FROM v_flight),
    b AS (SELECT CAST(least(floor((dep_delay - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin FROM v_flight, e)
    SELECT bin, round(any_value(lo) + bin * (any_value(hi - lo) / 40), 6) AS low, count(*) AS n
    FROM b, e GROUP BY bin""",
)
def histogram(spark, sf_dir):
    binned = profiling.histogram(flights(spark, sf_dir), "dep_delay", 40)
    return binned.select("bin", rounded("low").alias("low"), "n")


@query(
    "corr_pearson_pairs",
    _union(
        [
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_rounded(f'corr({a}, {b})')} AS r FROM lineitem"
            for a, b in combinations(LINE_COLUMNS, 2)
        ]
    ),
)
def corr_pearson_pairs(spark, sf_dir):
    pairs = ranking.pearson_pairs(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)
    return pairs.select("col_a", "col_b", rounded("r").alias("r"))


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in LINE_COLUMNS
)


@query(
    "corr_spearman_pairs",
    f"WITH ranks AS (SELECT {_RANKS} FROM lineitem) "
    + _union(
        [
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_rounded(f'corr({a}, {b})')} AS rho FROM ranks"
            for a, b in combinations(LINE_COLUMNS, 2)
        ]
    ),
)
def corr_spearman_pairs(spark, sf_dir):
    pairs = ranking.spearman_pairs(table(spark, sf_dir, "lineitem"), LINE_COLUMNS)
    return pairs.select("col_a", "col_b", rounded("rho").alias("rho"))


@query(
    "corr_spearman_pairwise_complete",
    f"""WITH {LABELLED}, v AS (SELECT * FROM v_doc WHERE quality IS NOT NULL),
    ranks AS (SELECT rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS x,
      rank() OVER (ORDER BY quality) + (count(*) OVER (PARTITION BY quality) - 1) / 2.0 AS y FROM v)
    SELECT 'n_chars' AS col_a, 'quality' AS col_b, {sql_rounded("corr(x, y)")} AS rho FROM ranks""",
)
def corr_spearman_pairwise_complete(spark, sf_dir):
    pairs = ranking.spearman_pairs(labelled_documents(spark, sf_dir), ["n_chars", "quality"])
    return pairs.select("col_a", "col_b", rounded("rho").alias("rho"))


@query(
    "binned_scatter",
    """SELECT CAST(floor(l_extendedprice / 5000) AS BIGINT) AS x_bin,
      CAST(floor(l_quantity / 5) AS BIGINT) AS y_bin, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def binned_scatter(spark, sf_dir):
    return profiling.binned_scatter(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", 5000, 5)


@query(
    "clip_effect",
    f"""WITH {FLIGHTS}, q AS (SELECT quantile_cont(dep_delay_new, 0.95) AS b FROM v_flight)
    SELECT 'before' AS stage, round(avg(dep_delay_new), 6) AS mean, round(stddev_samp(dep_delay_new), 6) AS stddev,
      round(max(dep_delay_new), 6) AS max FROM v_flight
    UNION ALL SELECT 'after', round(avg(least(dep_delay_new, b)), 6), round(stddev_samp(least(dep_delay_new, b)), 6),
      round(max(least(dep_delay_new, b)), 6) FROM v_flight, q""",
)
def clip_effect(spark, sf_dir):
    raw = flights(spark, sf_dir).select("dep_delay_new")
    clipped = cleaning.clip_at_quantile(raw, "dep_delay_new", 0.95)
    effect = profiling.clip_effect(raw, clipped, "dep_delay_new")
    return effect.select("stage", *[rounded(c).alias(c) for c in ("mean", "stddev", "max")])
