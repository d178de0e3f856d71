"""Airport ranks over a rolling window of days, each flight given the rank known on its own day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaywright.operators.graph import pagerank_by
from delaywright.operators.skew import ROWS_PER_TASK, join_lookup

WINDOW_DAYS = 7
STEPS = 10


def rolling_airport_ranks(
    df: DataFrame, date: str, airport: str, destination: str, delay: str, days: int = WINDOW_DAYS, steps: int = STEPS
) -> DataFrame:
    """``(date, id, pagerank)``: for every day of ``df`` the airports' PageRank over the positive
    delays of the ``days`` days before it.

    Delays are summed up by day and pair of airports before they are given to the windows that
    hold them, so a window costs at most the pairs of airports. Days without delays before them,
    and airports without any, have no rows; nulls in a day, airport or delay count nowhere.
    """
    known = F.col(date).isNotNull() & F.col(airport).isNotNull() & F.col(destination).isNotNull() & (F.col(delay) > 0)
    daily = df.filter(known).groupBy(date, F.col(airport).alias("src"), F.col(destination).alias("dst")).agg(F.sum(delay).alias("weight"))
    following = F.explode(F.sequence(F.date_add(date, 1), F.date_add(date, days))).alias("_day")
    spread = daily.select(following, "src", "dst", "weight")
    asked = df.select(F.col(date).alias("_day")).distinct()
    edges = spread.join(asked, "_day", "left_semi").groupBy("_day", "src", "dst").agg(F.sum("weight").alias("weight"))
    return pagerank_by(edges, "_day", iterations=steps, cut_every=2).withColumnRenamed("_day", date)


def with_origin_rank(
    df: DataFrame,
    ranks: DataFrame,
    date: str,
    prior_airport: str,
    row_id: str,
    output: str = "prior_flight_origin_delay_pagerank",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the rank that ``prior_airport``, where the aircraft came from, has on the flight's day;
    0 where it has none."""
    lookup = ranks.select(date, F.col("id").alias(prior_airport), F.col("pagerank").alias(output))
    joined = join_lookup(df, lookup, [date, prior_airport], [row_id], rows_per_task=rows_per_task)
    return joined.withColumn(output, F.coalesce(output, F.lit(0.0)))
