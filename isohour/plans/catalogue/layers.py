"""Keys, keep-latest, enrichment, marts and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.keys import surrogate_key as key_of
from isohour.functions.times import instant
from isohour.operators import marts, upsert
from isohour.operators.dedup import keep_latest, union_sources
from isohour.plans import refresh
from isohour.plans.catalogue.inputs import (
    AS_OF,
    DIGITS,
    MEASURE_LIST,
    cities,
    countries,
    latest,
    mean_sql,
    observations,
    table,
    with_tables,
)
from isohour.plans.catalogue.registry import Register
from isohour.plans.catalogue.tables import payload_documents
from isohour.session import scratch_path
from isohour.sources.tables import without_folders

register = Register()


@register(
    with_tables(
        f"""
SELECT event_id, city_id, "timestamp", {MEASURE_LIST}, ingestion_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY city_id, "timestamp"
                               ORDER BY ingestion_ts DESC, event_id DESC) AS rn
  FROM (SELECT * FROM obs WHERE ingestion_ts < TIMESTAMP '2024-01-20'
        UNION ALL
        SELECT * FROM obs WHERE ingestion_ts >= TIMESTAMP '2024-01-18'))
WHERE rn = 1"""
    )
)
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    rows = observations(spark, folder)
    archive = rows.where(F.col("ingestion_ts") < instant("2024-01-20"))
    live = rows.where(F.col("ingestion_ts") >= instant("2024-01-18"))
    return keep_latest(
        union_sources(live, archive), ("city_id", "timestamp"), tie_break=("event_id",)
    )


@register(
    with_tables(
        f"""
SELECT event_id, city_id, "timestamp", {MEASURE_LIST}, ingestion_ts FROM latest"""
    )
)
def dedup_latest_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    """Keep-latest by partial aggregation instead of ranking."""
    return keep_latest(
        observations(spark, folder),
        ("city_id", "timestamp"),
        tie_break=("event_id",),
        form="aggregate",
    )


@register(
    """SELECT event_id,
       md5(CAST(user_id AS VARCHAR) || '|' || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')) AS hour_key,
       md5(event_type || '|' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS day_key
FROM events"""
)
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    second = F.to_date("ts").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour("ts"), F.minute("ts"), F.second("ts").cast("decimal(18,6)")
    )
    return table(spark, folder, "events").select(
        "event_id",
        key_of(F.col("user_id"), second).alias("hour_key"),
        key_of(F.col("event_type"), F.to_date("ts")).alias("day_key"),
    )


@register(
    with_tables(
        """
SELECT o.event_id, o.city_id, c.city_name AS city, c.longitude, c.latitude,
       r.country_name AS country
FROM obs o LEFT JOIN city c ON o.city_id = c.city_id
LEFT JOIN country r ON c.country_id = r.country_id""",
        series=30,
    )
)
def enrich_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """30 series against 25 cities: the rows of five series find no city."""
    rows = observations(spark, folder, series=30).select("event_id", "city_id")
    return marts.with_geography(rows, cities(spark, folder), countries(spark, folder)).select(
        "event_id", "city_id", *marts.GEOGRAPHY
    )


_HOURLY = f""", hourly AS (
  SELECT o."timestamp" AS observation_timestamp, c.city_name AS city, c.longitude, c.latitude,
         r.country_name AS country, o.temperature, o.precipitation, o.wind_speed, o.wind_gusts,
         o.humidity, o.pressure,
         md5(c.city_name || '|' || strftime(o."timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key,
         TIMESTAMP '{AS_OF}' AS update_ts
  FROM latest o LEFT JOIN city c ON o.city_id = c.city_id
  LEFT JOIN country r ON c.country_id = r.country_id)"""
_DAILY = f""", daily AS (
  SELECT CAST(o."timestamp" AS DATE) AS observation_date, c.city_name AS city, c.longitude,
         c.latitude, r.country_name AS country,
         {mean_sql("o.temperature")} AS avg_temperature,
         min(o.temperature) AS min_temperature, max(o.temperature) AS max_temperature,
         max(o.temperature) - min(o.temperature) AS thermal_range,
         CAST(sum(CAST(o.precipitation AS DECIMAL(18,2))) AS DOUBLE) AS total_precipitation,
         count(*) FILTER (WHERE o.precipitation > 0) AS rainy_hours,
         max(o.wind_speed) AS max_wind_speed, {mean_sql("o.wind_speed")} AS avg_wind_speed,
         max(o.wind_gusts) AS max_wind_gusts, {mean_sql("o.humidity")} AS avg_humidity,
         {mean_sql("o.pressure")} AS avg_pressure,
         md5(c.city_name || '|' || CAST(CAST(o."timestamp" AS DATE) AS VARCHAR)) AS tech_key,
         TIMESTAMP '{AS_OF}' AS update_ts
  FROM latest o LEFT JOIN city c ON o.city_id = c.city_id
  LEFT JOIN country r ON c.country_id = r.country_id
  GROUP BY ALL)"""


@register(with_tables(_HOURLY + " SELECT * FROM hourly", series=30))
def hourly_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.hourly_mart(
        latest(spark, folder, series=30), cities(spark, folder), countries(spark, folder), AS_OF
    )


@register(with_tables(_DAILY + " SELECT * FROM daily", series=30))
def daily_mart(spark: SparkSession, folder: str) -> DataFrame:
    return marts.daily_mart(
        latest(spark, folder, series=30),
        cities(spark, folder),
        countries(spark, folder),
        AS_OF,
        scale=DIGITS,
    )


_BATCH = """, target AS (
  SELECT city_id, "timestamp", temperature FROM latest
  WHERE "timestamp" < TIMESTAMP '2024-01-30'
), batch AS (
  SELECT city_id, "timestamp", temperature + 1 AS temperature FROM latest
  WHERE "timestamp" >= TIMESTAMP '2024-01-28')"""
_UPSERTED = (
    _BATCH
    + """
SELECT t.* FROM target t
ANTI JOIN batch b ON t.city_id = b.city_id AND t."timestamp" = b."timestamp"
UNION ALL SELECT * FROM batch"""
)


def _target_and_batch(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = latest(spark, folder).select("city_id", "timestamp", "temperature")
    target = rows.where(F.col("timestamp") < instant("2024-01-30"))
    batch = rows.where(F.col("timestamp") >= instant("2024-01-28")).withColumn(
        "temperature", F.col("temperature") + 1
    )
    return target, batch


@register(with_tables(_UPSERTED))
def upsert_delete_insert(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _target_and_batch(spark, folder)
    return upsert.replace_keys(target, batch, ("city_id", "timestamp"))


@register(with_tables(_UPSERTED))
def upsert_stored_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert on a stored month-partitioned table, the batch applied twice."""
    target, batch = _target_and_batch(spark, folder)
    path = scratch_path(spark, "upserted")
    for rows in (target, batch, batch):
        upsert.upsert(spark, path, rows, ("city_id", "timestamp"), "timestamp")
    return without_folders(spark.read.parquet(path))


@register(with_tables(_UPSERTED))
def upsert_stored_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """And on a table laid out by day, of which only the batch's days are rewritten."""
    target, batch = _target_and_batch(spark, folder)
    path = scratch_path(spark, "upserted")
    for rows in (target, batch):
        upsert.upsert(spark, path, rows, ("city_id", "timestamp"), "timestamp", grain="day")
    return without_folders(spark.read.parquet(path))


@register(
    with_tables(
        f""", target AS (
  SELECT city_id, "timestamp", "timestamp" + INTERVAL 3 HOUR AS ingestion_ts FROM latest
  WHERE "timestamp" < TIMESTAMP '2024-01-30'
), batch AS (
  SELECT city_id, "timestamp", temperature FROM latest
  WHERE "timestamp" >= TIMESTAMP '2024-01-28')
SELECT b.*, TIMESTAMP '{AS_OF}' AS update_ts,
       coalesce(t.ingestion_ts, TIMESTAMP '{AS_OF}') AS ingestion_ts
FROM batch b
LEFT JOIN target t ON t.city_id = b.city_id AND t."timestamp" = b."timestamp\""""
    )
)
def audit_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    rows = latest(spark, folder).select("city_id", "timestamp", "temperature")
    target = rows.where(F.col("timestamp") < instant("2024-01-30")).select(
        "city_id", "timestamp", (F.col("timestamp") + F.expr("INTERVAL 3 HOURS")).alias("ingestion_ts")
    )
    batch = rows.where(F.col("timestamp") >= instant("2024-01-28")).withColumn(
        "update_ts", instant(AS_OF)
    )
    return upsert.carry_first_seen(batch, target, ("city_id", "timestamp"), AS_OF)


_FEEDS = (("punctual", 0), ("delayed", 60))


@register(
    with_tables(
        """, feeds(feed, delay) AS (VALUES ('punctual', 0), ('delayed', 60)
), arrivals AS (
  SELECT f.feed, o.event_id, o.city_id, o."timestamp", o.temperature,
         o.ingestion_ts + CASE WHEN o.event_id % 5 = 0 THEN f.delay ELSE 0 END * INTERVAL 1 HOUR
           AS ingestion_ts
  FROM obs o, feeds f
), full_run AS (
  SELECT feed, city_id, "timestamp", arg_max(event_id, (ingestion_ts, event_id)) AS event_id
  FROM arrivals GROUP BY ALL
), first_run AS (
  SELECT feed, city_id, "timestamp", arg_max(event_id, (ingestion_ts, event_id)) AS event_id
  FROM arrivals WHERE ingestion_ts < TIMESTAMP '2024-01-21' GROUP BY ALL
), second_run AS (
  SELECT feed, city_id, "timestamp", arg_max(event_id, (ingestion_ts, event_id)) AS event_id
  FROM arrivals WHERE "timestamp" >= TIMESTAMP '2024-01-21' - INTERVAL 2 DAY GROUP BY ALL
), incremental AS (
  SELECT f.* FROM first_run f ANTI JOIN second_run s
    ON f.feed = s.feed AND f.city_id = s.city_id AND f."timestamp" = s."timestamp"
  UNION ALL SELECT * FROM second_run
)
SELECT coalesce(a.feed, b.feed) AS feed,
       count(a.feed) AS full_rows, count(b.feed) AS incremental_rows,
       count(*) FILTER (WHERE a.event_id IS DISTINCT FROM b.event_id) AS different_keys
FROM full_run a FULL JOIN incremental b
  ON a.feed = b.feed AND a.city_id = b.city_id AND a."timestamp" = b."timestamp"
GROUP BY 1"""
    )
)
def full_refresh_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """A first run plus one incremental run against a full refresh: equal while no row arrives
    later than the look-back, and off by the late keys otherwise."""
    rows = observations(spark, folder).select(
        "event_id", "city_id", "timestamp", "temperature", "ingestion_ts"
    )
    keys = ("feed", "city_id", "timestamp")
    cut = instant("2024-01-21")
    feeds = F.explode(
        F.array(*[F.struct(F.lit(n).alias("feed"), F.lit(d).alias("delay")) for n, d in _FEEDS])
    )
    delay = F.when(F.col("event_id") % 5 == 0, F.col("_f.delay")).otherwise(0)
    arrivals = rows.withColumn("_f", feeds).select(
        F.col("_f.feed").alias("feed"),
        "event_id",
        "city_id",
        "timestamp",
        (F.col("ingestion_ts") + F.make_dt_interval(F.lit(0), delay)).alias("ingestion_ts"),
    )
    tie = ("event_id",)
    full = keep_latest(arrivals, keys, tie_break=tie)
    first = keep_latest(arrivals.where(F.col("ingestion_ts") < cut), keys, tie_break=tie)
    window = F.col("timestamp") >= cut - F.expr("INTERVAL 2 DAYS")
    second = keep_latest(arrivals.where(window), keys, tie_break=tie)
    incremental = upsert.replace_keys(first, second, keys)
    sides = full.select(*keys, F.col("event_id").alias("full_id")).join(
        incremental.select(*keys, F.col("event_id").alias("incremental_id")), list(keys), "full"
    )
    return sides.groupBy("feed").agg(
        F.count("full_id").alias("full_rows"),
        F.count("incremental_id").alias("incremental_rows"),
        F.count_if(~F.col("full_id").eqNullSafe(F.col("incremental_id"))).alias("different_keys"),
    )


@register(
    with_tables(
        """, arrivals AS (
  SELECT "timestamp", ingestion_ts + (event_id % 97) * INTERVAL 1 HOUR AS ingestion_ts FROM obs)
SELECT CAST("timestamp" AS DATE) AS observation_date, count(*) AS late_rows FROM arrivals
WHERE "timestamp" < ingestion_ts - INTERVAL 2 DAY GROUP BY 1"""
    )
)
def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    delay = F.make_dt_interval(F.lit(0), (F.col("event_id") % 97).cast("int"))
    arrivals = observations(spark, folder).select(
        "timestamp", (F.col("ingestion_ts") + delay).alias("ingestion_ts")
    )
    return refresh.late_rows(arrivals, refresh.Lookback().observations)


@register(
    with_tables(
        _DAILY
        + f""" SELECT *, TIMESTAMP '{AS_OF}' AS ingestion_ts FROM daily""",
    )
)
def warehouse_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job: landed payload files to the stored daily mart."""
    house = refresh.Warehouse(scratch_path(spark, "warehouse"))
    cities(spark, folder).write.parquet(house.dim_city)
    countries(spark, folder).write.parquet(house.dim_country)
    landing = f"{house.root}/landing"
    payload_documents(latest(spark, folder)).select("body").write.text(landing)
    refresh.ingest(spark, house, landing, AS_OF)
    refresh.refresh_observations(spark, house, AS_OF)
    refresh.refresh_marts(spark, house, AS_OF, scale=DIGITS)
    return without_folders(spark.read.parquet(house.mart_weather_daily))
