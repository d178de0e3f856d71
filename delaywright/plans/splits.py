"""Chronological splits and time folds."""

from __future__ import annotations

from delaywright.operators import splitting
from delaywright.plans.registry import query
from delaywright.plans.views import FLIGHTS, PARTS, flights, iso, rounded, with_parts

THREE_PARTS = (
    FLIGHTS
    + """,
v_pos AS (
  SELECT *, row_number() OVER (ORDER BY fl_date, flight_id) AS pos, count(*) OVER () AS total FROM v_flight),
v_cut AS (
  SELECT *, CAST(floor(total * 0.8) AS BIGINT) AS end_train FROM v_pos),
v_three AS (
  SELECT *, CASE WHEN pos <= CAST(floor(end_train * 0.7) AS BIGINT) THEN 'train'
    WHEN pos <= end_train THEN 'validation' ELSE 'test' END AS part
  FROM v_cut)"""
)


@query("split_chrono", f"WITH {PARTS} SELECT flight_id, part FROM v_part")
def split_chrono(spark, sf_dir):
    return with_parts(flights(spark, sf_dir)).select("flight_id", "part")


@query(
    "split_train_val_test",
    f"WITH {THREE_PARTS} SELECT flight_id, part FROM v_three",
)
def split_train_val_test(spark, sf_dir):
    parts = splitting.split_train_val_test(flights(spark, sf_dir), "fl_date", "flight_id")
    return parts.select("flight_id", "part")


@query(
    "training_validation_flag",
    f"WITH {THREE_PARTS} SELECT flight_id, part = 'validation' AS is_validation FROM v_three WHERE part <> 'test'",
)
def training_validation_flag(spark, sf_dir):
    parts = splitting.split_train_val_test(flights(spark, sf_dir), "fl_date", "flight_id")
    return splitting.training_with_validation_flag(parts).select("flight_id", "is_validation")


@query(
    "split_report",
    f"""WITH {THREE_PARTS} SELECT part, count(*) AS rows, round(count(*) * 100.0 / any_value(total), 6) AS pct,
      strftime(min(fl_date), '%Y-%m-%d') AS first_day, strftime(max(fl_date), '%Y-%m-%d') AS last_day
    FROM v_three GROUP BY part""",
)
def split_report(spark, sf_dir):
    parts = splitting.split_train_val_test(flights(spark, sf_dir), "fl_date", "flight_id")
    report = splitting.split_report(parts, "fl_date")
    return report.select(
        "part",
        "rows",
        rounded("pct").alias("pct"),
        iso("first_day").alias("first_day"),
        iso("last_day").alias("last_day"),
    )


def _fold_sql(train_start: str) -> str:
    return f"""WITH {FLIGHTS},
    v_pos AS (SELECT fl_date, row_number() OVER (ORDER BY fl_date, flight_id) AS pos FROM v_flight),
    s AS (SELECT count(*) AS n, count(*) // 3 AS tr, count(*) // 10 AS te FROM v_flight),
    f AS (SELECT CAST(i + 1 AS INTEGER) AS fold, {train_start} AS a, i * te + tr AS b, i * te + tr + te AS c
      FROM s, range(0, (SELECT (n - tr - te) // te FROM s)) t(i)),
    w AS (SELECT fold, 'train' AS role, a AS start_row, b AS end_row FROM f
      UNION ALL SELECT fold, 'test', b + 1, c FROM f)
    SELECT fold, role, start_row, end_row, count(*) AS rows, strftime(min(fl_date), '%Y-%m-%d') AS first_day,
      strftime(max(fl_date), '%Y-%m-%d') AS last_day
    FROM w JOIN v_pos ON pos BETWEEN start_row AND end_row GROUP BY ALL"""


def _fold_report(spark, sf_dir, make_folds):
    base = flights(spark, sf_dir).select("flight_id", "fl_date")
    folds = make_folds(splitting.total_rows(base))
    report = splitting.fold_report(base, "fl_date", "flight_id", folds)
    return report.withColumn("first_day", iso("first_day")).withColumn("last_day", iso("last_day"))


@query("cv_sliding_bounds", _fold_sql("i * te + 1"))
def cv_sliding_bounds(spark, sf_dir):
    return _fold_report(spark, sf_dir, splitting.sliding_folds)


@query("cv_expanding_bounds", _fold_sql("CAST(1 AS BIGINT)"))
def cv_expanding_bounds(spark, sf_dir):
    return _fold_report(spark, sf_dir, splitting.expanding_folds)


@query(
    "cv_hashed_folds",
    f"""WITH {FLIGHTS} SELECT flight_id, CAST(CAST('0x' || substr(md5(CAST(flight_id AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER)
      AS fold FROM v_flight""",
)
def cv_hashed_folds(spark, sf_dir):
    """The folds of the random cross-validation, row by row."""
    return splitting.hashed_folds(flights(spark, sf_dir).select("flight_id"), "flight_id", 3)
