"""Streaming forms, each run to the end of the input; the results equal the batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.plans.catalogue.inputs import (
    AS_OF,
    DIGITS,
    MEASURE_LIST,
    latest,
    mean_sql,
    observed,
    table,
    with_tables,
)
from isohour.plans.catalogue.registry import Register
from isohour.plans.catalogue.tables import payload_documents
from isohour.schemas import MEASURES
from isohour.session import scratch_path
from isohour.sources import deltas
from isohour.sources.tables import without_folders
from isohour.streaming import observations as live

register = Register()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return live.parquet_stream(spark, folder, schema, "events.parquet")


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return live.with_event_time(observed(_events(spark, folder)))


@register(
    with_tables(
        f"""
SELECT "timestamp", city_id, {MEASURE_LIST}, TIMESTAMP '{AS_OF}' AS ingestion_ts FROM latest"""
    )
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Landed payload files to the raw table."""
    root = scratch_path(spark, "stream")
    payload_documents(latest(spark, folder)).select("body").write.text(f"{root}/landing")
    live.ingest_payloads(
        spark, f"{root}/landing", f"{root}/raw", f"{root}/refused", f"{root}/state", AS_OF
    ).awaitTermination()
    return without_folders(spark.read.parquet(f"{root}/raw"))


@register("SELECT event_id, ts, user_id, value FROM events")
def stream_without_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    root = scratch_path(spark, "stream")
    events = _events(spark, folder).select("event_id", "ts", "user_id", "value")
    doubled = events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    rows = live.without_repeats(live.with_event_time(doubled, "ts"), ["event_id"])
    live.append_to(rows, f"{root}/out", f"{root}/state").awaitTermination()
    stored = spark.read.parquet(f"{root}/out")
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register(
    with_tables(
        f"""
SELECT city_id, "timestamp", ingestion_ts, event_id, {MEASURE_LIST} FROM latest"""
    )
)
def stream_latest_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Keep-latest by state, the changed hours of each micro-batch stored as a delta."""
    root = scratch_path(spark, "stream")
    rows = live.latest_per_hour(
        _timed(spark, folder), ("event_id", *MEASURES), tie_break=("event_id",)
    )
    keys = ("city_id", "timestamp")
    live.latest_into(rows, f"{root}/out", f"{root}/state", keys, "timestamp").awaitTermination()
    return deltas.read(spark, f"{root}/out", keys, "timestamp", "ingestion_ts")


@register(
    with_tables(
        f"""
SELECT CAST("timestamp" AS DATE) AS observation_date, city_id, count(*) AS rows,
       {mean_sql("temperature")} AS avg_temperature, min(temperature) AS min_temperature,
       max(temperature) AS max_temperature,
       CAST(sum(CAST(precipitation AS DECIMAL(18,2))) AS DOUBLE) AS total_precipitation,
       count(*) FILTER (WHERE precipitation > 0) AS rainy_hours
FROM latest GROUP BY 1, 2"""
    )
)
def stream_daily_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows to the latest ones, and those of touched days to daily totals."""
    root = scratch_path(spark, "stream")
    live.daily_into(
        observed(_events(spark, folder)),
        f"{root}/latest",
        f"{root}/out",
        f"{root}/state",
        scale=DIGITS,
    ).awaitTermination()
    return without_folders(spark.read.parquet(f"{root}/out"))


@register(
    with_tables(
        f"""
SELECT city_id, "timestamp", ingestion_ts, event_id, {MEASURE_LIST} FROM latest"""
    )
)
def stream_upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows upserted batch by batch: the later row of table and batch wins."""
    root = scratch_path(spark, "stream")
    live.upsert_into(
        observed(_events(spark, folder)),
        f"{root}/out",
        f"{root}/state",
        ("city_id", "timestamp"),
        "timestamp",
        latest="ingestion_ts",
    ).awaitTermination()
    return without_folders(spark.read.parquet(f"{root}/out"))
