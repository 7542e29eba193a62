"""Date and time column builders.

"Calendar" days count midnights crossed; "elapsed" days are 24-hour spans rounded down, so a
delivery six minutes before the estimate is day -1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.functions.clean import col

MICROS_PER_DAY = 86_400_000_000

# Meteorological season of each month, northern reading.
SEASONS = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Autumn", 10: "Autumn", 11: "Autumn",
}


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def days_between(later: Column | str, earlier: Column | str, kind: str = "calendar") -> Column:
    """Days from ``earlier`` to ``later`` as a bigint; NULL when either is absent."""
    if kind == "calendar":
        return F.datediff(col(later), col(earlier)).cast("bigint")
    if kind == "elapsed":
        return F.floor((micros(later) - micros(earlier)) / F.lit(MICROS_PER_DAY)).cast("bigint")
    raise ValueError(f"kind must be calendar or elapsed, not {kind!r}")


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Unrounded days as a double."""
    return (micros(later) - micros(earlier)) / F.lit(float(MICROS_PER_DAY))


def elapsed_hours(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(3_600_000_000.0)


def month_start(ts: Column | str) -> Column:
    return F.trunc(col(ts).cast("date"), "MM")


def months_between_starts(later: Column | str, earlier: Column | str) -> Column:
    later, earlier = col(later), col(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def date_key(d: Column | str) -> Column:
    """YYYYMMDD as an int."""
    d = col(d).cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def sunday_week(d: Column | str) -> Column:
    """Week 0-53 of the year; week 1 starts on the first Sunday. Not the ISO week."""
    d = col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def season(month: Column | str) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SEASONS.items() for x in pair])
    return names[col(month)]


def is_weekend(d: Column | str) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def date_spine(spark: SparkSession, bounds: DataFrame, lo: str, hi: str, out: str = "full_date") -> DataFrame:
    """One row per day between two columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias(out))
