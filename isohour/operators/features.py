"""Lag, rolling and calendar features for temperature and rain models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from isohour.functions.measures import rained, trailing_mean
from isohour.functions.times import HOUR, calendar, micros, month_key
from isohour.operators.running import over_trailing_rows

CHUNK_ROWS = 8192


@dataclass(frozen=True)
class Trail:
    """Row lags and trailing means of one measure."""

    measure: str
    prefix: str
    lags: tuple[int, ...]
    means: tuple[int, ...]

    def names(self) -> list[str]:
        return [f"{self.prefix}lag_{n}h" for n in self.lags] + [
            f"{self.prefix}roll_{n}h" for n in self.means
        ]


# Lags, windows and feature lists of the two model sets.
TEMPERATURE = Trail("temperature", "", (1, 2, 3, 12, 24, 48, 168), (6, 24, 72))
HUMIDITY = Trail("humidity", "humidity_", (1, 24), (6,))
PRESSURE = Trail("pressure", "pressure_", (1, 24), (6,))
PRECIPITATION = Trail("precipitation", "precip_", (1, 24), (6,))
CALENDAR = ("hour", "day_of_week", "month", "day_of_year")


@dataclass(frozen=True)
class FeatureSet:
    trails: tuple[Trail, ...]
    statics: tuple[str, ...]

    def trailing(self) -> list[str]:
        return [name for trail in self.trails for name in trail.names()]

    def columns(self) -> list[str]:
        return [*self.trailing(), *CALENDAR, *self.statics]

    def reach(self) -> int:
        return max(n for trail in self.trails for n in (*trail.lags, *trail.means))


EXPERIMENT = FeatureSet((TEMPERATURE, HUMIDITY, PRESSURE), ("latitude", "longitude", "city_id"))
PRODUCTION = FeatureSet(
    (TEMPERATURE, HUMIDITY, PRESSURE, PRECIPITATION), ("latitude", "longitude")
)


def lag_columns(trails: Sequence[Trail], window: WindowSpec) -> dict[str, Column]:
    return {
        f"{t.prefix}lag_{n}h": F.lag(t.measure, n).over(window) for t in trails for n in t.lags
    }


def mean_columns(
    trails: Sequence[Trail], window: WindowSpec, scale: int | None = None
) -> dict[str, Column]:
    """Means of the n rows before the current one; fewer rows and NULLs are allowed."""
    return {
        f"{t.prefix}roll_{n}h": trailing_mean(F.col(t.measure), n, window, scale)
        for t in trails
        for n in t.means
    }


def with_trails(
    df: DataFrame,
    trails: Sequence[Trail],
    series: str = "city_id",
    ts: str = "timestamp",
    *,
    scale: int | None = None,
    lags: bool = True,
    means: bool = True,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add lag and mean columns. ``df`` holds one row per (series, ts).

    Series are cut into chunks of ``chunk_rows`` rows (8192 if not given) that carry the rows before them along, so a
    series of any length is spread over tasks. Nothing is counted beforehand.
    """

    def columns(window: WindowSpec) -> Mapping[str, Column]:
        made: dict[str, Column] = {}
        if lags:
            made |= lag_columns(trails, window)
        if means:
            made |= mean_columns(trails, window, scale)
        return made

    reach = max(
        [n for t in trails for n in t.lags if lags] + [n for t in trails for n in t.means if means]
    )
    return over_trailing_rows(
        df, columns, reach, ts, month_key(F.col(ts)), [series], max(chunk_rows or CHUNK_ROWS, reach)
    )


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(calendar(F.col(ts)))


def with_rain_label(df: DataFrame) -> DataFrame:
    return df.withColumn("rained", rained(F.col("precipitation")))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have every one of the trailing features."""
    return df.na.drop(subset=list(columns))


def with_clock_trails(
    df: DataFrame,
    trails: Sequence[Trail],
    series: str = "city_id",
    ts: str = "timestamp",
    *,
    scale: int | None = None,
    chunk_hours: int | None = None,
) -> DataFrame:
    """Lags and means by the clock, at any minute: every row of ``df`` comes out once.

    The n-th lag is the value exactly n hours earlier, the mean is over the n hours before the row.
    Series are cut into spans of ``chunk_hours`` (8 times the reach if not given) that carry the
    hours before them along. Rows without a series or a time have neither lags nor means.
    """
    reach = max(n for t in trails for n in (*t.lags, *t.means))
    span = max(chunk_hours or 8 * reach, reach) * HOUR
    placed = df.withColumn("_us", micros(F.col(ts)))
    known = F.col(series).isNotNull() & F.col("_us").isNotNull()
    # what has no place in a series is left where it was read, instead of all in one task
    chunk = F.when(known, F.floor(F.col("_us") / F.lit(span))).otherwise(F.spark_partition_id())
    in_tail = known & (F.pmod("_us", F.lit(span)) >= span - reach * HOUR)
    placed = placed.withColumns({"_known": known, "_own": chunk, "_in_tail": in_tail})
    both = F.array(F.col("_own"), F.col("_own") + 1)
    copied = placed.withColumn(
        "_chunk", F.explode(F.when(F.col("_in_tail"), both).otherwise(F.array("_own")))
    )
    window = Window.partitionBy(series, "_known", "_chunk").orderBy("_us")
    made = {
        f"{t.prefix}lag_{n}h": F.max(t.measure).over(window.rangeBetween(-n * HOUR, -n * HOUR))
        for t in trails
        for n in t.lags
    } | {
        f"{t.prefix}roll_{n}h": trailing_mean(F.col(t.measure), n * HOUR, window, scale, by_range=True)
        for t in trails
        for n in t.means
    }
    trailed = copied.withColumns({n: F.when(F.col("_known"), c) for n, c in made.items()})
    return trailed.where("_chunk = _own").drop("_us", "_known", "_own", "_in_tail", "_chunk")


def feature_table(
    df: DataFrame,
    features: FeatureSet,
    series: str = "city_id",
    ts: str = "timestamp",
    *,
    scale: int | None = None,
    mode: str = "rows",
    complete_only: bool = True,
    chunk_rows: int | None = None,
) -> DataFrame:
    """All features of a set next to the observation, with the rain label.

    ``mode="rows"``: the n-th lag is the n-th earlier row, gaps or not. ``mode="clock"``: it is
    the value n hours earlier, and ``chunk_rows`` counts hours.
    """
    if mode not in ("rows", "clock"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "clock":
        table = with_clock_trails(df, features.trails, series, ts, scale=scale, chunk_hours=chunk_rows)
    else:
        table = with_trails(df, features.trails, series, ts, scale=scale, chunk_rows=chunk_rows)
    table = with_calendar(table, ts)
    if "precipitation" in df.columns:
        table = with_rain_label(table)
    return drop_incomplete(table, features.trailing()) if complete_only else table
