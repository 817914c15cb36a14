"""Time columns. All of them work on TIMESTAMP_NTZ without a trip through the session zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F


#: Microseconds of an hour.
HOUR = 3_600_000_000


def instant(value: str | datetime | date | Column) -> Column:
    """A TIMESTAMP_NTZ literal; the run's ``as_of`` stands in for now()."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    """The start of the hour of ``ts``."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def day_of(ts: Column) -> Column:
    """Midnight of the day of ``ts``."""
    return F.to_date(ts).cast("timestamp_ntz")


def month_key(ts: Column) -> Column:
    """yyyymm as an int: the partition column of every table."""
    return F.year(ts) * 100 + F.month(ts)


def day_key(ts: Column) -> Column:
    """yyyymmdd as an int."""
    return month_key(ts) * 100 + F.dayofmonth(ts)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 on the same zone-free clock."""
    seconds = (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")
    minutes = F.minute(ts).cast("bigint") * F.lit(HOUR // 60)
    days = F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(24 * HOUR)
    return days + F.hour(ts) * F.lit(HOUR) + minutes + seconds


def days_before(as_of: Column, days: int, *, snap_to_day: bool = False) -> Column:
    since = as_of - F.make_dt_interval(F.lit(days))
    return day_of(since) if snap_to_day else since


def plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours)


def backfill_range(as_of: Column, years: int = 2) -> tuple[Column, Column]:
    """First and last day of the archive load, as yyyy-MM-dd texts."""
    last = F.to_date(as_of)
    return (
        F.date_format(F.add_months(last, -12 * years), "yyyy-MM-dd"),
        F.date_format(last, "yyyy-MM-dd"),
    )


def since(df: DataFrame, ts: str, start: Column, end: Column | None = None) -> DataFrame:
    """Rows of a closed time range, pruned by month or day where the table is laid out so.

    Spark cannot derive the folder predicate from the time predicate, so both are stated.
    """
    kept = df.where(F.col(ts) >= start)
    if end is not None:
        kept = kept.where(F.col(ts) <= end)
    if "ym" in df.columns:
        kept = kept.where(F.col("ym") >= month_key(start))
        if end is not None:
            kept = kept.where(F.col("ym") <= month_key(end))
    if {"ym", "day"} <= set(df.columns):
        folder = F.col("ym") * 100 + F.col("day")
        kept = kept.where(folder >= day_key(start))
        if end is not None:
            kept = kept.where(folder <= day_key(end))
    return kept


def calendar(ts: Column) -> dict[str, Column]:
    """Hour, day of week (Monday 0), month and day of year."""
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "day_of_year": F.dayofyear(ts),
    }


def version_label(as_of: Column, stem: str = "gbt_v1") -> Column:
    return F.concat(F.lit(f"{stem}_"), F.date_format(as_of, "yyyy-MM"))
