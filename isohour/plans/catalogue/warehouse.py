"""The refresh job on stored tables: two landings, an incremental run, a full refresh, data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import instant
from isohour.operators import checks
from isohour.plans import refresh
from isohour.plans.catalogue.inputs import (
    AS_OF,
    DIGITS,
    MEASURE_LIST,
    cities,
    countries,
    mean_sql,
    observations,
    with_tables,
)
from isohour.plans.catalogue.registry import Register
from isohour.schemas import MEASURES
from isohour.session import scratch_path
from isohour.sources import tables

register = Register()

FIRST_RUN = "2024-01-30 12:00:00"
PULLED_AGAIN = "2024-01-29 12:00:00"
#: 30 series against 25 cities: the rows of five series find no city.
WIDE = 30


def _landings(spark: SparkSession, folder: str, series: int) -> list[tuple[str, DataFrame]]:
    """Raw rows with all their repeats. The second landing pulls a day again, one degree warmer."""
    rows = observations(spark, folder, series).drop("event_id")
    first = rows.where(F.col("ingestion_ts") < instant(FIRST_RUN))
    second = rows.where(F.col("ingestion_ts") >= instant(PULLED_AGAIN)).withColumn(
        "temperature", F.col("temperature") + 1
    )
    return [(FIRST_RUN, first.drop("ingestion_ts")), (AS_OF, second.drop("ingestion_ts"))]


def _house(spark: SparkSession, folder: str) -> refresh.Warehouse:
    house = refresh.Warehouse(scratch_path(spark, "warehouse"))
    cities(spark, folder).write.parquet(house.dim_city)
    countries(spark, folder).write.parquet(house.dim_country)
    return house


def _refreshed(spark: SparkSession, folder: str, series: int = 8) -> refresh.Warehouse:
    """Each landing appended and followed by a run of the job."""
    house = _house(spark, folder)
    for as_of, rows in _landings(spark, folder, series):
        tables.append_raw(rows, house.raw_weather_hourly, as_of, house.grain)
        refresh.refresh_observations(spark, house, as_of)
        refresh.refresh_marts(spark, house, as_of, scale=DIGITS)
    return house


_LATEST = ", ".join(f"{c} DESC NULLS LAST" for c in ("loaded", *MEASURES))
_KEPT = f"""row_number() OVER (PARTITION BY city_id, "timestamp" ORDER BY {_LATEST}) = 1"""
_RAW = f""", raw AS (
  SELECT city_id, "timestamp", {MEASURE_LIST}, TIMESTAMP '{FIRST_RUN}' AS loaded FROM obs
  WHERE ingestion_ts < TIMESTAMP '{FIRST_RUN}'
  UNION ALL
  SELECT city_id, "timestamp", temperature + 1, wind_speed, wind_gusts, precipitation, humidity,
         pressure, TIMESTAMP '{AS_OF}' FROM obs
  WHERE ingestion_ts >= TIMESTAMP '{PULLED_AGAIN}'
)"""
# observations after each run: the second looks back two days to the second
_RUNS = f"""{_RAW}, first_seen AS (
  SELECT * FROM raw WHERE loaded = TIMESTAMP '{FIRST_RUN}' QUALIFY {_KEPT}
), again AS (
  SELECT * FROM raw WHERE "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY QUALIFY {_KEPT}
), kept AS (
  SELECT f.* FROM first_seen f ANTI JOIN again a
    ON f.city_id = a.city_id AND f."timestamp" = a."timestamp"
  UNION ALL SELECT * FROM again
)"""


def _daily_sql(source: str, where: str, run: str) -> str:
    return f"""
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
         TIMESTAMP '{run}' AS update_ts
  FROM {source} o LEFT JOIN city c ON o.city_id = c.city_id
  LEFT JOIN country r ON c.country_id = r.country_id
  WHERE {where} GROUP BY ALL"""


# the daily mart looks back one day, from the start of that day
_SINCE = f"date_trunc('day', TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY)"
_MARTS = f"""{_RUNS}, day_before AS ({_daily_sql("first_seen", "true", FIRST_RUN)}
), day_now AS ({_daily_sql("kept", f'o."timestamp" >= {_SINCE}', AS_OF)}
)"""


@register(
    with_tables(
        f"""{_MARTS}
SELECT n.*, coalesce(b.update_ts, n.update_ts) AS ingestion_ts FROM day_now n
LEFT JOIN day_before b ON b.city = n.city AND b.observation_date = n.observation_date
UNION ALL
SELECT b.*, b.update_ts FROM day_before b
ANTI JOIN day_now n ON b.city = n.city AND b.observation_date = n.observation_date"""
    )
)
def warehouse_refresh_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A first and an incremental run: the daily mart with its audit times."""
    house = _refreshed(spark, folder)
    return tables.without_folders(spark.read.parquet(house.mart_weather_daily))


@register(
    with_tables(
        f"""{_RUNS}
SELECT city_id, "timestamp", {MEASURE_LIST},
       md5(city_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key,
       loaded AS ingestion_ts,
       CASE WHEN "timestamp" >= TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY THEN TIMESTAMP '{AS_OF}'
            ELSE TIMESTAMP '{FIRST_RUN}' END AS update_ts
FROM kept"""
    )
)
def observations_refresh_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The observation table after a first and an incremental run over repeated raw rows."""
    house = _house(spark, folder)
    for as_of, rows in _landings(spark, folder, 8):
        tables.append_raw(rows, house.raw_weather_hourly, as_of, house.grain)
        refresh.refresh_observations(spark, house, as_of)
    return tables.without_folders(spark.read.parquet(house.int_weather_observations))


@register(
    with_tables(
        f"""{_RAW}, whole AS (SELECT * FROM raw QUALIFY {_KEPT}
), daily AS ({_daily_sql("whole", "true", AS_OF)}
)
SELECT *, TIMESTAMP '{AS_OF}' AS ingestion_ts FROM daily"""
    )
)
def warehouse_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """An incremental history, then a full refresh: every day corrected, audit times anew."""
    house = _refreshed(spark, folder)
    refresh.refresh_observations(spark, house, AS_OF, full_refresh=True)
    refresh.refresh_marts(spark, house, AS_OF, full_refresh=True, scale=DIGITS)
    return tables.without_folders(spark.read.parquet(house.mart_weather_daily))


def _tests_sql() -> str:
    """One row per data test of the tables that the job has written."""
    key = """md5(city_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key"""
    hour = """md5(c.city_name || '|' || strftime(o."timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key"""
    sources = {
        "dim_city": "city",
        "dim_country": "country",
        "stg_dim_city": "city",
        "stg_dim_country": "country",
        "raw_weather_hourly": "raw",
        "stg_weather_hourly": f"(SELECT *, {key} FROM raw)",
        "int_weather_observations": f"(SELECT *, {key} FROM kept)",
        "mart_weather_daily": "(SELECT * FROM day_now UNION ALL SELECT b.* FROM day_before b ANTI JOIN day_now n "
        "ON b.city IS NOT DISTINCT FROM n.city AND b.observation_date = n.observation_date)",
        "mart_weather_hourly": f"""(SELECT o."timestamp" AS observation_timestamp, c.city_name AS city,
            r.country_name AS country, {hour} FROM kept o LEFT JOIN city c ON o.city_id = c.city_id
            LEFT JOIN country r ON c.country_id = r.country_id)""",
    }
    made = []
    for name, rows in sources.items():
        rules = checks.WAREHOUSE_RULES[name]
        found = [(c, "not_null", f'{rows} t WHERE t."{c}" IS NULL') for c in rules.not_null]
        found += [
            (c, "unique", f'(SELECT "{c}" FROM {rows} t WHERE "{c}" IS NOT NULL GROUP BY 1 HAVING count(*) > 1)')
            for c in rules.unique
        ]
        for c, (parent, column) in (rules.relationships or {}).items():
            known = f'SELECT "{column}" FROM {sources[parent]}'
            found.append((c, "relationships", f'{rows} t WHERE t."{c}" NOT IN ({known})'))
        made += [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{test}' AS test, count(*) AS failing_rows FROM {body}"
            for c, test, body in found
        ]
    return " UNION ALL ".join(made)


@register(with_tables(f"{_MARTS} {_tests_sql()}", series=WIDE))
def data_test_results(spark: SparkSession, folder: str) -> DataFrame:
    """All data tests on a warehouse with rows of unknown cities."""
    return refresh.data_test_results(spark, _refreshed(spark, folder, WIDE))
