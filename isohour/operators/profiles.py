"""Profiles of an observation table, per series, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from isohour.schemas import MEASURES

# The short measure names used in profile columns.
SHORT = {"temperature": "temp", "precipitation": "precip"}
NULL_NAMES = {"temperature": "temp"}


def coverage(df: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    return df.groupBy(series).agg(*_coverage(ts))


def _coverage(ts: str) -> list[Column]:
    return [F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), F.count("*").alias("rows")]


def duplicate_hours(df: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """Rows against distinct hours. Rows are first counted per (series, hour)."""
    per_hour = df.groupBy(series, ts).agg(F.count("*").alias("_n"))
    return per_hour.groupBy(series).agg(
        F.sum("_n").alias("rows"), F.count(ts).alias("unique_hours")
    )


def null_profile(
    df: DataFrame, series: str = "city_id", measures: Sequence[str] = MEASURES
) -> DataFrame:
    return df.groupBy(series).agg(*_nulls(measures))


def _nulls(measures: Sequence[str]) -> list[Column]:
    return [
        F.count_if(F.col(m).isNull()).alias(f"{NULL_NAMES.get(m, m)}_nulls") for m in measures
    ]


def sanity_ranges(
    df: DataFrame, series: str = "city_id", measures: Sequence[str] = MEASURES
) -> DataFrame:
    return df.groupBy(series).agg(*_ranges(measures))


def _ranges(measures: Sequence[str]) -> list[Column]:
    return [
        f(m).alias(f"{prefix}_{SHORT.get(m, m)}")
        for m in measures
        for prefix, f in (("min", F.min), ("max", F.max))
    ]


def full_profile(df: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """Coverage, duplicate hours, nulls and ranges fused into one scan."""
    per_hour = df.groupBy(series, ts).agg(
        F.count("*").alias("rows"), *_nulls(MEASURES), *_ranges(MEASURES)
    )
    summed = ["rows", *[f"{NULL_NAMES.get(m, m)}_nulls" for m in MEASURES]]
    ranged = [SHORT.get(m, m) for m in MEASURES]
    return per_hour.groupBy(series).agg(
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
        F.count(ts).alias("unique_hours"),
        *[F.sum(c).alias(c) for c in summed],
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in ranged],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in ranged],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("city_id", "timestamp")) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")


def head(df: DataFrame, order: Sequence[str] = ("city_id", "timestamp"), rows: int = 5) -> DataFrame:
    """A first look: the first rows of an order."""
    return df.orderBy(*order).limit(rows)


def extent(df: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """Rows, series and time span of a data set."""
    per_series = df.groupBy(series).agg(*_coverage(ts))
    return per_series.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.count(series).alias("n_series"),
        F.min("min_ts").alias("date_range_from"),
        F.max("max_ts").alias("date_range_to"),
    )
