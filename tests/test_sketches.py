"""Distinct counts from united sketches."""

from pyspark.sql import functions as F

from delaywright.operators import sketches


def test_unions_stay_within_the_bound(spark):
    rows = spark.range(200_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 37_000).alias("v"))
    daily = sketches.sketch_by(rows.unionByName(spark.sql("SELECT 3L AS day, CAST(NULL AS BIGINT) AS v")), ["day"], "v").cache()
    assert daily.count() == 10
    whole = sketches.estimate(daily.withColumn("all", F.lit(1)), ["all"]).first()["estimate"]
    assert abs(whole - 37_000) <= sketches.relative_error() * 37_000
    exact = {r["day"]: r["n"] for r in rows.groupBy("day").agg(F.count_distinct("v").alias("n")).collect()}
    for r in sketches.estimate(daily, ["day"]).collect():
        assert abs(r["estimate"] - exact[r["day"]]) <= sketches.relative_error() * exact[r["day"]]


def test_no_rows_and_nulls(spark):
    empty = spark.createDataFrame([], "day int, v bigint")
    assert sketches.estimate(sketches.sketch_by(empty, ["day"], "v"), ["day"]).count() == 0
    nulls = spark.createDataFrame([(1, None)], "day int, v bigint")
    assert sketches.estimate(sketches.sketch_by(nulls, ["day"], "v"), ["day"]).first()["estimate"] == 0
