"""The driver tables read as observations: events are raw rows, nations cities, regions countries.

Several events of a series fall into one hour, which makes them copies of an observation with
different load times. Each reader is paired with the common table expression of the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import hour_of
from isohour.operators.dedup import keep_latest

AS_OF = "2024-01-31 00:00:00"
SERIES = 8
DIGITS = 2  # measures of the driver tables have at most two


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def observations(spark: SparkSession, folder: str, series: int = SERIES) -> DataFrame:
    return observed(table(spark, folder, "events"), series)


def observed(events: DataFrame, series: int = SERIES) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    wave = F.col("event_id") % 40
    return events.select(
        "event_id",
        (F.col("user_id") % series).cast("int").alias("city_id"),
        hour_of(F.col("ts")).alias("timestamp"),
        F.col("value").alias("temperature"),
        wave.cast("double").alias("wind_speed"),
        (wave + k % 20).cast("double").alias("wind_gusts"),
        F.greatest(k - 50, F.lit(0)).cast("double").alias("precipitation"),
        k.cast("double").alias("humidity"),
        (1000 + F.col("event_id") % 30).cast("double").alias("pressure"),
        F.col("ts").alias("ingestion_ts"),
    )


def latest(spark: SparkSession, folder: str, series: int = SERIES) -> DataFrame:
    """One row per (city_id, timestamp)."""
    rows = observations(spark, folder, series)
    return keep_latest(rows, ("city_id", "timestamp"), tie_break=("event_id",))


def cities(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        key.alias("city_id"),
        F.col("n_name").alias("city_name"),
        (key.cast("double") * 1.5).alias("latitude"),
        (key.cast("double") - 10.0).alias("longitude"),
        F.col("n_regionkey").alias("country_id"),
    )


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country_name")
    )


MEASURE_LIST = "temperature, wind_speed, wind_gusts, precipitation, humidity, pressure"


def with_tables(body: str, series: int = SERIES, recursive: bool = False) -> str:
    """SQL with obs, latest, city and country defined in front of ``body``."""
    return f"""
WITH {"RECURSIVE " if recursive else ""}parsed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), obs AS (
  SELECT event_id,
         CAST(user_id % {series} AS INTEGER) AS city_id,
         date_trunc('hour', ts) AS "timestamp",
         value AS temperature,
         CAST(event_id % 40 AS DOUBLE) AS wind_speed,
         CAST(event_id % 40 + k % 20 AS DOUBLE) AS wind_gusts,
         CAST(greatest(k - 50, 0) AS DOUBLE) AS precipitation,
         CAST(k AS DOUBLE) AS humidity,
         CAST(1000 + event_id % 30 AS DOUBLE) AS pressure,
         ts AS ingestion_ts
  FROM parsed
), latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, "timestamp"
                                 ORDER BY ingestion_ts DESC, event_id DESC) AS rn
    FROM obs)
  WHERE rn = 1
), city AS (
  SELECT n_nationkey AS city_id, n_name AS city_name,
         CAST(n_nationkey AS DOUBLE) * CAST(1.5 AS DOUBLE) AS latitude,
         CAST(n_nationkey AS DOUBLE) - CAST(10 AS DOUBLE) AS longitude,
         n_regionkey AS country_id
  FROM nation
), country AS (
  SELECT r_regionkey AS country_id, r_name AS country_name FROM region
){body}"""


def mean_sql(column: str, over: str = "") -> str:
    tail = f" OVER {over}" if over else ""
    return (
        f"CAST(sum(CAST({column} AS DECIMAL(18,2))){tail} AS DOUBLE) / count({column}){tail}"
    )
