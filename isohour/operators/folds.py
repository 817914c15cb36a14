"""Expanding time-ordered cross-validation folds, cut at hour boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isohour.functions.times import month_key
from isohour.operators.running import running_totals


def hour_blocks(df: DataFrame, ts: str = "timestamp", folds: int = 5) -> DataFrame:
    """One row per hour: its row count and its block, 0 to ``folds``.

    With n rows and test size n // (folds + 1), block i >= 1 is the test part of fold i and block
    0 the rest, which is only trained on. An hour falls into the block of its first row, so no
    hour is split between training and test.
    """
    hours = df.where(F.col(ts).isNotNull()).groupBy(ts).agg(F.count("*").alias("rows"))
    placed = running_totals(
        hours, {"before": F.col("rows")}, [ts], month_key(F.col(ts)), totals=True
    )
    test_rows = F.floor(F.col("before_total") / F.lit(folds + 1))
    first = F.col("before_total") - folds * test_rows
    block = F.when(F.col("before") < first, 0).otherwise(
        F.floor(F.try_divide(F.col("before") - first, test_rows)) + 1
    )
    return placed.select(ts, "rows", block.cast("int").alias("block"))


def block_starts(df: DataFrame, ts: str = "timestamp", folds: int = 5) -> DataFrame:
    """One row: the first hour of blocks 1 to ``folds``."""
    blocks = hour_blocks(df, ts, folds)
    return blocks.agg(
        *[
            F.min(F.when(F.col("block") >= i, F.col(ts))).alias(f"start_{i}")
            for i in range(1, folds + 1)
        ]
    )


def with_block(df: DataFrame, ts: str = "timestamp", folds: int = 5) -> DataFrame:
    """Add ``block`` to every row. The five boundaries reach the rows as one scalar subquery, so
    the rows are not shuffled. Rows without a time belong to no block."""
    starts = block_starts(df, ts, folds)
    packed = starts.select(F.struct(*starts.columns)).scalar()
    block: Column = F.lit(0)
    for i in range(1, folds + 1):
        reached = F.col(ts) >= packed.getField(f"start_{i}")
        block = block + F.coalesce(reached.cast("int"), F.lit(0))
    return df.withColumn("block", F.when(F.col(ts).isNotNull(), block))


def split(blocked: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of fold 1 to 5."""
    return blocked.where(F.col("block") < fold), blocked.where(F.col("block") == fold)


def fold_summary(df: DataFrame, ts: str = "timestamp", folds: int = 5) -> DataFrame:
    """Rows, first and last hour per fold and part."""
    per_block = (
        hour_blocks(df, ts, folds)
        .groupBy("block")
        .agg(
            F.sum("rows").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
        )
    )
    numbered = per_block.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    return (
        numbered.where(F.col("block") <= F.col("fold"))
        .withColumn("part", F.when(F.col("block") == F.col("fold"), "test").otherwise("train"))
        .groupBy("fold", "part")
        .agg(
            F.sum("rows").alias("rows"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
        )
    )
