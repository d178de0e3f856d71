"""Column expressions used by cleaning and feature building. Everything stays in codegen."""

from __future__ import annotations

import calendar
import datetime as dt
import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnLike = Column | str

# Class limits of the delay target, in minutes.
DELAY_MINUTES = 15
SIGNIFICANT_DELAY_MINUTES = 60


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


# --- clock and calendar -------------------------------------------------------------------


def clock_hour(hhmm: ColumnLike) -> Column:
    """Hour of an HHMM clock integer (1345 → 13)."""
    return F.floor(_col(hhmm) / 100).cast("int")


def clock_minutes(hhmm: ColumnLike) -> Column:
    """Minutes from midnight of an HHMM clock integer (1345 → 825)."""
    value = _col(hhmm)
    return (F.floor(value / 100) * 60 + value % 100).cast("int")


def minutes_until_midnight(hhmm: ColumnLike) -> Column:
    return (F.lit(1440) - clock_minutes(hhmm)).cast("int")


def epoch_minutes(ts: ColumnLike) -> Column:
    """Whole minutes since 1970-01-01 00:00 on the timestamp's own clock (no session zone)."""
    value = _col(ts)
    days = F.datediff(F.to_date(value), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    return days * 1440 + F.hour(value) * 60 + F.minute(value)


def recency_days(date: ColumnLike, as_of: Column | dt.date) -> Column:
    """Age of a row in days. ``as_of`` is a parameter, so features do not change by run day."""
    reference = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.datediff(reference, _col(date))


def day_of_week(date: ColumnLike) -> Column:
    """Monday = 1 … Sunday = 7."""
    return (F.weekday(_col(date)) + 1).cast("int")


def calendar_parts(date: ColumnLike) -> dict[str, Column]:
    value = _col(date)
    return {
        "year": F.year(value),
        "quarter": F.quarter(value),
        "month": F.month(value),
        "day_of_month": F.dayofmonth(value),
        "day_of_week": day_of_week(value),
        "day_of_year": F.dayofyear(value),
    }


def christmas_travel(date: ColumnLike) -> Column:
    """1 from December 20 to January 10, both included."""
    value = _col(date)
    month, day = F.month(value), F.dayofmonth(value)
    inside = ((month == 12) & (day >= 20)) | ((month == 1) & (day <= 10))
    return F.when(inside, 1).otherwise(0)


# Fixed values: (month, day) holidays, (month, weekday Monday=1, n-th) holidays with n = -1 for the
# last one of the month, and the first year of June 19.
HOLIDAY_DATES = ((1, 1), (7, 4), (11, 11), (12, 25))
HOLIDAY_WEEKDAYS = ((1, 1, 3), (2, 1, 3), (5, 1, -1), (9, 1, 1), (10, 1, 2), (11, 4, 4))
JUNETEENTH_SINCE = 2021
#: Days between June 19 and the nearer end of its year.
JUNETEENTH_REACH = 169


def federal_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Dates of the US federal holidays by their legal rules, one row per holiday."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))

    def date_of(month: int, day: int) -> Column:
        return F.make_date("year", F.lit(month), F.lit(day))

    def nth(month: int, weekday: int, n: int) -> Column:
        if n < 0:
            last = F.last_day(date_of(month, 1))
            return F.date_sub(last, F.pmod(F.weekday(last) + 1 - weekday, F.lit(7)))
        first = date_of(month, 1)
        shift = F.pmod(F.lit(weekday) - (F.weekday(first) + 1), F.lit(7))
        return F.date_add(first, shift + 7 * (n - 1))

    days = [date_of(m, d) for m, d in HOLIDAY_DATES] + [nth(m, w, n) for m, w, n in HOLIDAY_WEEKDAYS]
    juneteenth = F.when(F.col("year") >= JUNETEENTH_SINCE, date_of(6, 19))
    listed = years.select(F.explode(F.array(*days, juneteenth)).alias("holiday"))
    return listed.filter(F.col("holiday").isNotNull())


def _is_holiday(day: dt.date, juneteenth: bool) -> bool:
    """Whether a day is a US federal holiday, by the legal rules."""
    last_week = (day + dt.timedelta(7)).month != day.month
    return (
        (day.month, day.day) in HOLIDAY_DATES
        or any(
            (day.month, day.isoweekday()) == (m, w) and (last_week if n < 0 else (day.day + 6) // 7 == n)
            for m, w, n in HOLIDAY_WEEKDAYS
        )
        or (juneteenth and (day.month, day.day) == (6, 19))
    )


@functools.cache
def _holiday_years(days_around: int) -> list[str]:
    """The indicator of every day of a year, one digit a day, for each kind of year: without and
    with June 19, common and leap years, by the weekday of January 1 (Monday first)."""
    if not 0 <= days_around < JUNETEENTH_REACH:
        raise ValueError("days around a holiday must not reach another year's June 19")

    def marks(year: int, juneteenth: bool) -> str:
        first, n = dt.date(year, 1, 1), 365 + calendar.isleap(year)
        days = [first + dt.timedelta(k) for k in range(-days_around, n + days_around)]
        found = [_is_holiday(day, juneteenth) for day in days]
        return "".join(
            "2" if found[k + days_around] else "1" if any(found[k : k + 2 * days_around + 1]) else "0" for k in range(n)
        )

    kinds = {(calendar.isleap(y), dt.date(y, 1, 1).weekday()): y for y in range(2001, 2401)}
    return [marks(kinds[leap, weekday], june) for june in (False, True) for leap in (False, True) for weekday in range(7)]


def holiday_indicator(date: ColumnLike, days_around: int = 3) -> Column:
    """2 on a holiday, 1 within ``days_around`` days of one, else 0 (unknown dates as well).

    A year's holidays follow from its first weekday, its length and whether June 19 is one, so a day
    is looked up in one of 28 literals: the rules themselves, written out for each day around a row's,
    would be too much generated code to be compiled.
    """
    value = F.to_date(_col(date))
    year = F.year(value)
    leap = ((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))).cast("int")
    kind = (year >= JUNETEENTH_SINCE).cast("int") * 14 + leap * 7 + F.weekday(F.trunc(value, "year"))
    years = F.array(*[F.lit(marks) for marks in _holiday_years(days_around)])
    return F.coalesce(F.substring(F.get(years, kind), F.dayofyear(value), F.lit(1)).cast("int"), F.lit(0))


def with_holiday_indicator(df: DataFrame, date: str, output: str = "federal_holiday_indicator") -> DataFrame:
    """Add the indicator; it is computed from the row's date, so no calendar and no span is needed."""
    return df.withColumn(output, holiday_indicator(date))


# --- cyclical encodings --------------------------------------------------------------------


def cyclic(value: ColumnLike, period: int) -> tuple[Column, Column]:
    """``(sin, cos)`` of a value on a circle with ``period`` steps."""
    angle = _col(value) * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


# --- delay classes ---------------------------------------------------------------------------


def positive_part(delay: ColumnLike) -> Column:
    """Early departures count as no delay; an unknown delay stays unknown."""
    value = _col(delay)
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def delay_flag(delay: ColumnLike, minutes: float, inclusive: bool = True) -> Column:
    """1 when delayed by at least (or more than) ``minutes``; unknown delays give null."""
    value = _col(delay)
    late = value >= minutes if inclusive else value > minutes
    return F.when(value.isNull(), F.lit(None)).when(late, 1).otherwise(0).cast("int")


def status_bucket(delay: ColumnLike) -> Column:
    # The limits and names of the classes.
    value = _col(delay)
    return (
        F.when(value <= 0, "On Time")
        .when(value <= DELAY_MINUTES, "Small Delay")
        .when(value > DELAY_MINUTES, "Large Delay")
    )


def part_of_day(hhmm: ColumnLike) -> Column:
    # The hours and names of the parts.
    hour = clock_hour(hhmm)
    return (
        F.when((hour >= 5) & (hour < 12), "Morning")
        .when((hour >= 12) & (hour < 18), "Afternoon")
        .when(hour.isNotNull(), "Night")
    )


def part_of_day_code(name: ColumnLike) -> Column:
    value = _col(name)
    return F.when(value == "Morning", 1).when(value == "Afternoon", 2).when(value == "Night", 3)


def recode(value: ColumnLike, labels: dict[str, str]) -> Column:
    """Replace codes by labels; an unlisted code becomes null."""
    out = None
    text = _col(value).cast("string")
    for code, label in labels.items():
        out = F.when(text == code, label) if out is None else out.when(text == code, label)
    return out


# --- dirty numbers ---------------------------------------------------------------------------


def weather_number(text: ColumnLike, trace_value: float | None = None, suffixes: bool = True) -> Column:
    """Number of a weather report field.

    ``T`` (trace) becomes ``trace_value`` (null by default, as a plain cast gives), a trailing
    quality letter such as ``12.5s`` is dropped, anything else that is no number becomes null.
    """
    value = F.trim(_col(text))
    number = F.regexp_extract(value, r"^([+-]?[0-9]*\.?[0-9]+)[A-Za-z]?$", 1) if suffixes else value
    parsed = number.try_cast("double")
    return F.when(value == "T", F.lit(trace_value).cast("double")).otherwise(parsed)


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike, default: float | None = 0.0) -> Column:
    """Division that gives ``default`` for a zero denominator instead of raising."""
    ratio = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))
