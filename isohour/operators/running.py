"""Running totals and trailing windows that never put a whole series into one task.

A plain window over one long series, or over all rows, runs in a single task. Here rows are cut
into buckets of bounded size; what a bucket needs from the rows before it is passed in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from isohour.session import materialise


def running_totals(
    df: DataFrame,
    values: Mapping[str, Column],
    order: Sequence[str],
    bucket: Column,
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Add, per name, the sum of the value over all earlier rows of the ``by`` group.

    ``bucket`` must rise with ``order``. Its totals (one row per group and bucket) are summed up
    first; then each bucket is summed on its own and the total of the buckets before is added.
    With ``totals`` also ``<name>_total``, the sum over the group. Rows with a NULL in ``by`` or
    in the bucket are dropped.
    """
    names = list(values)
    df = df.withColumns({"_bucket": bucket, **{f"_{n}": v for n, v in values.items()}})
    sums = df.groupBy(*by, "_bucket").agg(*[F.sum(f"_{n}").alias(f"_{n}_sum") for n in names])
    group = Window.partitionBy(*by)
    earlier_buckets = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    columns = [
        F.coalesce(F.sum(f"_{n}_sum").over(earlier_buckets), F.lit(0)).alias(f"_{n}_start")
        for n in names
    ]
    if totals:
        columns += [F.sum(f"_{n}_sum").over(group).alias(f"{n}_total") for n in names]
    starts = sums.select(*by, "_bucket", *columns)
    earlier_rows = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = df.withColumns(
        {f"_{n}_inside": F.sum(f"_{n}").over(earlier_rows) - F.col(f"_{n}") for n in names}
    )
    joined = inside.join(starts, [*by, "_bucket"])
    helpers = [f"_{n}{part}" for n in names for part in ("", "_inside", "_start")]
    return joined.withColumns(
        {n: F.col(f"_{n}_start") + F.col(f"_{n}_inside") for n in names}
    ).drop("_bucket", *helpers)


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Add ``_range``: the number of a range of ``order``, all of about the same size.

    For orders without a natural bucket such as a month. The ranges come from a sample, so the
    result is written to the shared folder: every later pass must see the same ranges.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return materialise(ranged, "ranges")


def over_trailing_rows(
    df: DataFrame,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    reach: int,
    order: str,
    bucket: Column,
    by: Sequence[str],
    chunk_rows: int = 8192,
) -> DataFrame:
    """Window columns that look at most ``reach`` rows back within each ``by`` series.

    Rows get their position in the series, series are cut into chunks of ``chunk_rows``
    positions, and the last ``reach`` rows of each chunk are copied in front of the next one.
    The result equals the plain window over the series for any gaps in it. Rows of a NULL series
    are dropped. ``order`` must be unique within a series.
    """
    if chunk_rows < reach:
        raise ValueError("chunk_rows must be at least reach")
    placed = running_totals(df, {"_pos": F.lit(1)}, [order], bucket, by)
    chunk = F.expr(f"_pos div {chunk_rows}")
    in_tail = F.col("_pos") % chunk_rows >= chunk_rows - reach
    copied = placed.withColumn(
        "_chunk", F.explode(F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))
    )
    window = Window.partitionBy(*by, "_chunk").orderBy("_pos")
    return (
        copied.withColumns(dict(columns(window)))
        .where(chunk == F.col("_chunk"))
        .drop("_pos", "_chunk")
    )


def tail_rows(
    df: DataFrame, rows: int, order: str, bucket: Column, by: Sequence[str]
) -> DataFrame:
    """The last ``rows`` rows of each series.

    Cut per bucket first: what is left for the series itself is ``rows`` per bucket at most.
    """
    last = F.row_number()
    in_bucket = Window.partitionBy(*by, "_bucket").orderBy(F.col(order).desc())
    in_series = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return (
        df.withColumn("_bucket", bucket)
        .withColumn("_rn", last.over(in_bucket))
        .where(F.col("_rn") <= rows)
        .withColumn("_rn", last.over(in_series))
        .where(F.col("_rn") <= rows)
        .drop("_bucket", "_rn")
    )
