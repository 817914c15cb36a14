"""Staging, union of sources and keep-latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from isohour import schemas
from isohour.functions.keys import surrogate_key


def staged(raw: DataFrame) -> DataFrame:
    """Raw columns with the surrogate key of (city, hour) before the load time."""
    return raw.select(
        "timestamp",
        "city_id",
        *schemas.MEASURES,
        surrogate_key(F.col("city_id"), F.col("timestamp")).alias("tech_key"),
        "ingestion_ts",
    )


def union_sources(live: DataFrame, archive: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return live.unionByName(archive)


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest: str = "ingestion_ts",
    tie_break: Sequence[str] | None = None,
    form: str = "rank",
) -> DataFrame:
    """One row per key: the one with the greatest ``latest``.

    Equal load times are settled by ``tie_break``, by default all remaining columns, so that the
    outcome never depends on row order. Both forms cut each task's rows to one per key before
    the shuffle, so a key that holds a third of all rows does not burden one task:
    ``rank`` by the group limit Spark places under a ``rn = 1`` filter, ``aggregate`` by partial
    aggregation.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in (*keys, latest)]
    order = [latest, *tie_break]
    if form == "rank":
        window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
    if form == "aggregate":
        row = F.struct(*[c for c in df.columns if c not in keys])
        best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
        return best.select(*keys, "_row.*").select(*df.columns)
    raise ValueError(f"unknown form {form!r}")
