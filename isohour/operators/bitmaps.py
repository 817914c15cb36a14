"""Hours seen per series as bitmaps: mergeable, 4 KB per series and 32,768 hours, no distinct shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from isohour.functions.times import HOUR, micros, plus_hours

#: Hours that one bitmap covers, and its bytes.
HOURS = 32_768
BYTES = HOURS // 8
EPOCH = "1970-01-01 00:00:00"


def hour_bitmaps(df: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """One row per (series, bucket): the hours seen, the rows, the first and the last time.

    Tasks combine rows before the shuffle. Times inside an hour count as that hour; rows without a
    time count as rows and set no bit (their bucket is NULL).
    """
    hour = F.floor(micros(F.col(ts)) / F.lit(HOUR)).cast("bigint")
    return df.groupBy(series, F.bitmap_bucket_number(hour).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(hour)).alias("hours"),
        F.count("*").alias("rows"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
    )


def merged(one: DataFrame, other: DataFrame, series: str = "city_id") -> DataFrame:
    """The bitmaps of both sides' rows together, such as stored ones and those of new rows."""
    return one.unionByName(other).groupBy(series, "bucket").agg(
        F.bitmap_or_agg("hours").alias("hours"),
        F.sum("rows").alias("rows"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
    )


def coverage(bitmaps: DataFrame, series: str = "city_id") -> DataFrame:
    """Rows, distinct hours and time span per series."""
    seen = F.when(F.col("bucket").isNotNull(), F.bitmap_count("hours")).otherwise(0)
    return bitmaps.groupBy(series).agg(
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.sum("rows").alias("rows"),
        F.sum(seen).alias("unique_hours"),
    )


def _set_positions(bitmap: Column) -> Column:
    """Positions of the set bits; bytes without one are passed over."""

    def bits(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, at + 1, F.lit(1))), 16, 10).cast("int")
        found = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: F.getbit(byte, b) == 1)
        return F.transform(found, lambda b: at * 8 + b)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BYTES - 1)), bits))


def seen_hours(bitmaps: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """One row per (series, hour) seen."""
    bucket, position = F.col("bucket"), F.col("_position").cast("bigint")
    # buckets from 1 on count hours from 1, the others count back from hour 0
    hour = F.when(bucket > 0, (bucket - 1) * HOURS + position + 1).otherwise(bucket * HOURS - position)
    at = plus_hours(F.lit(EPOCH).cast("timestamp_ntz"), hour.cast("int"))
    dated = bitmaps.where(bucket.isNotNull())
    return dated.select(series, "bucket", F.explode(_set_positions(F.col("hours"))).alias("_position")).select(
        series, at.alias(ts)
    )


def missing_hours(bitmaps: DataFrame, series: str = "city_id", ts: str = "timestamp") -> DataFrame:
    """Runs of hours between a series' first and last one in which it has no row.

    The window sees distinct hours, 8,766 a year and series, however many rows there are.
    """
    following = F.lead(ts).over(Window.partitionBy(series).orderBy(ts))
    hours = ((micros(F.col("_next")) - micros(F.col(ts))) / F.lit(HOUR)).cast("bigint") - 1
    return (
        seen_hours(bitmaps, series, ts)
        .withColumn("_next", following)
        .withColumn("missing", hours)
        .where("missing > 0")
        .select(
            series,
            plus_hours(F.col(ts), F.lit(1)).alias("gap_start"),
            plus_hours(F.col("_next"), F.lit(-1)).alias("gap_end"),
            "missing",
        )
    )
