"""Scans, filters, seeds, layout, payloads and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import day_of, days_before, instant, since
from isohour.operators import forecast as fc
from isohour.operators.dedup import union_sources as bag_union
from isohour.plans import refresh
from isohour.plans.catalogue.inputs import (
    AS_OF,
    MEASURE_LIST,
    latest,
    observations,
    table,
    with_tables,
)
from isohour.plans.catalogue.registry import Register
from isohour.session import scratch_path
from isohour.sources import payload, seeds, state
from isohour.sources import tables as store

register = Register()


@register("SELECT event_id, ts, user_id, value FROM events")
def scan_project(spark: SparkSession, folder: str) -> DataFrame:
    return store.scan(table(spark, folder, "events"), ("event_id", "ts", "user_id", "value"))


@register(
    with_tables(
        """, seed_country(country_id, country_name) AS (VALUES (1, 'Spain')),
seed_city(city_id, city_name, latitude, longitude, country_id) AS (
  VALUES (1, 'Madrid', 40.4168::DOUBLE, -3.7038::DOUBLE, 1),
         (2, 'Barcelona', 41.3874::DOUBLE, 2.1686::DOUBLE, 1),
         (3, 'Alicante', 38.3452::DOUBLE, -0.4810::DOUBLE, 1),
         (4, 'Valladolid', 41.6523::DOUBLE, -4.7245::DOUBLE, 1))
SELECT o.city_id, s.city_name, s.latitude, s.longitude, c.country_name,
       count(*) AS rows, max(o."timestamp") AS last_ts
FROM obs o LEFT JOIN seed_city s ON o.city_id = s.city_id
LEFT JOIN seed_country c ON s.country_id = c.country_id
GROUP BY ALL"""
    )
)
def seed_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every observed series next to its seed row; those without one are listed too."""
    per_city = (
        observations(spark, folder)
        .groupBy("city_id")
        .agg(F.count("*").alias("rows"), F.max("timestamp").alias("last_ts"))
    )
    places = seeds.cities(spark).join(seeds.countries(spark), "country_id", "left")
    return per_city.join(places, "city_id", "left").select(
        "city_id", "city_name", "latitude", "longitude", "country_name", "rows", "last_ts"
    )


@register("SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'")
def future_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts")
    return payload.drop_future(rows, "2024-01-20 00:00:00", "ts")


@register(
    """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 23:00:00'"""
)
def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts", "value")
    return since(rows, "ts", instant("2024-01-05 00:00:00"), instant("2024-01-12 23:00:00"))


@register(
    """SELECT event_id, ts FROM events
WHERE ts >= TIMESTAMP '2024-01-30 13:30:00' - INTERVAL 2 DAY"""
)
def incremental_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts")
    return since(rows, "ts", days_before(instant("2024-01-30 13:30:00"), 2))


@register(
    """SELECT 'daily' AS mart, event_id, ts FROM events
WHERE ts >= date_trunc('day', TIMESTAMP '2024-01-30 13:30:00' - INTERVAL 1 DAY)
UNION ALL
SELECT 'hourly' AS mart, event_id, ts FROM events
WHERE ts >= date_trunc('day', TIMESTAMP '2024-01-30 13:30:00' - INTERVAL 2 DAY)"""
)
def incremental_day_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts")
    as_of, days = instant("2024-01-30 13:30:00"), refresh.Lookback()
    daily, hourly = (
        since(rows, "ts", days_before(as_of, n, snap_to_day=True)).withColumn("mart", F.lit(name))
        for name, n in (("daily", days.daily), ("hourly", days.hourly))
    )
    return daily.unionByName(hourly)


@register(
    with_tables(
        f"""
SELECT city_id, "timestamp", temperature, precipitation, humidity, pressure FROM latest
WHERE "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL 8 DAY"""
    )
)
def recent_history(spark: SparkSession, folder: str) -> DataFrame:
    return fc.recent_history(latest(spark, folder), AS_OF).select(
        "city_id", "timestamp", *fc.STATE
    )


def _split_sources(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The archive and the live feed; they overlap by two days."""
    archive = rows.where(F.col("ingestion_ts") < instant("2024-01-20"))
    live = rows.where(F.col("ingestion_ts") >= instant("2024-01-18"))
    return archive, live


@register(
    with_tables(
        """
SELECT CAST("timestamp" AS DATE) AS observation_date, count(*) AS rows FROM (
  SELECT "timestamp" FROM obs WHERE ingestion_ts < TIMESTAMP '2024-01-20'
  UNION ALL
  SELECT "timestamp" FROM obs WHERE ingestion_ts >= TIMESTAMP '2024-01-18')
GROUP BY 1"""
    )
)
def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    archive, live = _split_sources(observations(spark, folder))
    return (
        bag_union(live, archive)
        .groupBy(F.to_date("timestamp").alias("observation_date"))
        .agg(F.count("*").alias("rows"))
    )


@register(
    """SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
       count(*) AS rows, min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts
FROM orders GROUP BY 1"""
)
def month_partition_profile(spark: SparkSession, folder: str) -> DataFrame:
    return refresh.month_partition_profile(table(spark, folder, "orders"), "o_orderdate")


@register(
    """SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
       count(*) AS rows,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-15' AND o_orderdate <= TIMESTAMP '1997-03-10'
GROUP BY 1"""
)
def month_pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write orders month by month, sorted; read a time range back from the months it touches."""
    path = scratch_path(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderdate", "o_custkey", "o_totalprice")
    store.write_table(orders, path, "o_orderdate", ("o_custkey", "o_orderdate"))
    stored = spark.read.parquet(path)
    kept = since(stored, "o_orderdate", instant("1996-01-15"), instant("1997-03-10"))
    return kept.groupBy("ym").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


def payload_documents(rows: DataFrame) -> DataFrame:
    """Observations packed into one payload per city and day, 24 hours at most each."""
    return payload.payload_of(
        rows.withColumn("day", day_of(F.col("timestamp"))), "city_id", "day"
    )


@register(
    with_tables(
        f"""
SELECT "timestamp", city_id, {MEASURE_LIST}, TIMESTAMP '{AS_OF}' AS ingestion_ts FROM latest"""
    )
)
def payload_explode(spark: SparkSession, folder: str) -> DataFrame:
    documents = payload_documents(latest(spark, folder)).select("body")
    return payload.to_rows(payload.parse(documents), AS_OF)


@register(
    with_tables(
        """, docs AS (
  SELECT city_id, CAST("timestamp" AS DATE) AS day, count(*) AS hours FROM latest GROUP BY 1, 2
), broken AS (
  SELECT CASE day(day) % 4 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing_field'
                           WHEN 2 THEN 'ragged_arrays' ELSE 'bad_time' END AS outcome
  FROM docs
)
SELECT 'loaded' AS outcome, count(*) AS documents, CAST(sum(hours) AS BIGINT) AS rows FROM docs
UNION ALL
SELECT outcome, count(*) AS documents, CAST(0 AS BIGINT) AS rows FROM broken GROUP BY outcome"""
    )
)
def payload_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every document once sound and once broken in one of four ways."""
    sound = payload_documents(latest(spark, folder))
    way = F.dayofmonth("day") % 4
    body = F.col("body")
    broken = sound.withColumn(
        "body",
        F.when(way == 0, F.expr("substring(body, 1, length(body) - 2)"))
        .when(way == 1, F.replace(body, F.lit('"pressure_msl"'), F.lit('"pressure_other"')))
        .when(way == 2, F.replace(body, F.lit('"time":['), F.lit('"time":["2024-01-01T00:00",')))
        .otherwise(F.replace(body, F.lit('"time":["'), F.lit('"time":["at '))),
    )
    parsed = payload.parse(sound.unionByName(broken).select("body"))
    hours = F.when(F.col("reason").isNull(), F.size("hourly.time")).otherwise(0)
    return parsed.groupBy(F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(
        F.count("*").alias("documents"), F.sum(hours).alias("rows")
    )


@register(
    with_tables(
        f"""
SELECT 'weather_hourly_ingestion' AS pipeline, TIMESTAMP '{AS_OF}' AS last_successful_run,
       min("timestamp") AS window_start, max("timestamp") AS window_end, count(*) AS rows_loaded
FROM obs WHERE "timestamp" <= TIMESTAMP '{AS_OF}'"""
    )
)
def ingestion_state(spark: SparkSession, folder: str) -> DataFrame:
    batch = payload.drop_future(observations(spark, folder), AS_OF)
    return state.batch_state(batch, "weather_hourly_ingestion", AS_OF)


