"""Continuous forms of the hourly job.

Event time is TIMESTAMP here, as watermarks demand, with the session zone set to UTC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from isohour.functions.measures import mean, total
from isohour.operators.dedup import keep_latest
from isohour.operators.upsert import folders_of, merge_latest, upsert
from isohour.sources import deltas, payload, tables

LATENESS = "2 days"


def landed_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New payload documents of a landing folder."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path)
        .select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("source_file"))
    )


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, name_filter: str | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def with_event_time(rows: DataFrame, ts: str = "timestamp", lateness: str = LATENESS) -> DataFrame:
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def without_repeats(rows: DataFrame, keys: Sequence[str], spread: int = 16) -> DataFrame:
    """Drop exact copies of a re-pull. The first copy stays, so only for identical ones.

    A stream cannot drop copies before the shuffle, and one key may have most of them. So copies
    are first dropped within ``spread`` shares of the input, by task, and then across the shares,
    where a key has ``spread`` copies at most. ``spread=1`` saves the first step and its state.
    """
    if spread > 1:
        rows = rows.withColumn("_share", F.spark_partition_id() % spread)
        rows = rows.dropDuplicatesWithinWatermark([*keys, "_share"]).drop("_share")
    return rows.dropDuplicatesWithinWatermark(list(keys))


def latest_per_hour(
    rows: DataFrame,
    columns: Sequence[str],
    series: str = "city_id",
    ts: str = "timestamp",
    latest: str = "ingestion_ts",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep-latest per (series, hour).

    With :func:`latest_into` every hour is stored at once and corrected later; with
    :func:`append_to` an hour comes out when it is final, that is, when the watermark has passed it.
    """
    order = F.struct(latest, *(tie_break or columns))
    return (
        rows.groupBy(series, F.window(ts, "1 hour").alias("_w"))
        .agg(F.max_by(F.struct(latest, *columns), order).alias("_row"))
        .select(F.col("_w.start").cast("timestamp_ntz").alias(ts), series, "_row.*")
    )


def daily_totals(
    rows: DataFrame, series: str = "city_id", ts: str = "timestamp", scale: int | None = None
) -> DataFrame:
    """Tumbling daily aggregates per series, of rows that are one per hour already; rows without a
    time belong to no day."""
    t, rain = F.col("temperature"), F.col("precipitation")
    return (
        rows.groupBy(F.window(ts, "1 day").alias("_w"), series)
        .agg(
            F.count("*").alias("rows"),
            mean(t, scale).alias("avg_temperature"),
            F.min(t).alias("min_temperature"),
            F.max(t).alias("max_temperature"),
            total(rain, scale).alias("total_precipitation"),
            F.count_if(rain > 0).alias("rainy_hours"),
        )
        .select(
            F.col("_w.start").cast("date").alias("observation_date"),
            series,
            "rows",
            "avg_temperature",
            "min_temperature",
            "max_temperature",
            "total_precipitation",
            "rainy_hours",
        )
    )


def ingest_payloads(
    spark: SparkSession, landing: str, raw: str, quarantine: str, checkpoint: str, as_of: str
) -> StreamingQuery:
    """Load new payload files: sound rows to the raw table, refused documents to quarantine.

    A replayed batch may append rows twice; raw tables allow that and keep-latest settles it.
    """

    def load(batch: DataFrame, _: int) -> None:
        parsed = payload.parse(batch).persist()
        rows = payload.drop_future(payload.to_rows(parsed, as_of), as_of)
        tables.append_raw(rows, raw)
        payload.quarantined(parsed, as_of).write.mode("append").parquet(quarantine)
        parsed.unpersist()

    return (
        landed_stream(spark, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append final rows to a Parquet folder; the file sink writes each batch exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )


def upsert_into(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    latest: str | None = None,
    grain: str = "day",
) -> StreamingQuery:
    """Upsert each micro-batch into a stored table; replays change nothing.

    With ``latest`` the later row of batch and table wins; without it the batch wins, which is
    right for aggregates in update mode.
    """

    def load(batch: DataFrame, _: int) -> None:
        if latest is None:
            upsert(batch.sparkSession, path, batch, keys, ts, grain=grain)
        else:
            upsert_latest(path, batch, keys, ts, latest, grain)

    return by_batch(rows, load, checkpoint)


def upsert_latest(
    path: str, batch: DataFrame, keys: Sequence[str], ts: str, latest: str, grain: str = "day"
) -> list[int | None]:
    """The later row of table and batch stays, per key; returns the folders written."""

    def merge(target: DataFrame, newer: DataFrame, by: Sequence[str]) -> DataFrame:
        return merge_latest(target, newer, by, latest)

    rows = keep_latest(batch, keys, latest)
    return upsert(batch.sparkSession, path, rows, keys, ts, grain=grain, merge=merge)


def latest_into(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ts: str,
    latest: str = "ingestion_ts",
    compact_every: int | None = 32,
) -> StreamingQuery:
    """Store each micro-batch's changes as one delta folder of a keep-latest table.

    ``rows`` hold one row per key and micro-batch, as :func:`latest_per_hour` emits them. A replay
    writes its folder again, and an older row never hides a newer one, so neither changes what
    ``deltas.read`` gives. Every ``compact_every`` batches deltas are folded into the snapshot; None
    leaves that to a job of its own. One stream at a time may compact a table.
    """
    run = deltas.run_name(checkpoint)

    def load(batch: DataFrame, number: int) -> None:
        deltas.add(batch, path, run, number, ts)
        _compact(batch.sparkSession, path, keys, ts, latest, number, compact_every)

    return by_batch(rows, load, checkpoint)


def _compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    ts: str,
    latest: str,
    number: int,
    every: int | None,
) -> None:
    if every and number % every == every - 1:
        deltas.compact(spark, path, keys, ts, latest, keep=every // 2)


def daily_into(
    rows: DataFrame,
    observations: str,
    daily: str,
    checkpoint: str,
    series: str = "city_id",
    ts: str = "timestamp",
    latest: str = "ingestion_ts",
    scale: int | None = None,
    compact_every: int | None = 32,
) -> StreamingQuery:
    """Raw rows to a keep-latest observation table (``deltas.read``) and its daily totals.

    Each micro-batch becomes one delta of the observations, and only the (series, day) pairs it
    holds are computed anew, from the stored rows of those days. So an hour that is pulled again
    counts once, a late correction reaches its day however old it is, and a replayed batch changes
    nothing. Rows without a time are stored and belong to no day.
    """
    run, keys, day = deltas.run_name(checkpoint), (series, ts), "observation_date"

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        deltas.add(keep_latest(batch, keys, latest), observations, run, number, ts)
        added = tables.read(spark, f"{observations}/delta/run={run}/batch={number}")
        days = [] if added is None else [d for d in folders_of(added, ts, "day") if d is not None]
        if days:
            pairs = added.select(F.col(series).alias("_series"), F.to_date(ts).alias("_day")).distinct()
            stored = deltas.read(spark, observations, keys, ts, latest, days)
            same = F.col(series).eqNullSafe(F.col("_series")) & (F.to_date(ts) == F.col("_day"))
            totals = daily_totals(stored.join(pairs, same, "left_semi"), series, ts, scale)
            upsert(spark, daily, totals, (series, day), day, grain="month")
        _compact(spark, observations, keys, ts, latest, number, compact_every)

    return by_batch(rows, load, checkpoint)


def by_batch(
    rows: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
