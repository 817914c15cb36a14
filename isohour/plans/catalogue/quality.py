"""Profiles and data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.keys import surrogate_key
from isohour.functions.times import instant
from isohour.operators import bitmaps, checks, profiles
from isohour.plans.catalogue.inputs import latest, observations, table, with_tables
from isohour.plans.catalogue.registry import Register
from isohour.schemas import MEASURES

register = Register()


@register(
    with_tables(
        """
SELECT city_id, min("timestamp") AS min_ts, max("timestamp") AS max_ts, count(*) AS rows
FROM obs GROUP BY city_id"""
    )
)
def temporal_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.coverage(observations(spark, folder)).orderBy("city_id")


@register(
    with_tables(
        """
SELECT city_id, count(*) AS rows, count(DISTINCT "timestamp") AS unique_hours
FROM obs GROUP BY city_id"""
    )
)
def duplicate_hours(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.duplicate_hours(observations(spark, folder))


_CUT = "2024-01-20"


def _bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Bitmaps of earlier and of later rows, put together."""
    rows = observations(spark, folder)
    early = F.col("ingestion_ts") < instant(_CUT)
    return bitmaps.merged(
        bitmaps.hour_bitmaps(rows.where(early)), bitmaps.hour_bitmaps(rows.where(~early))
    )


@register(
    with_tables(
        """
SELECT city_id, min("timestamp") AS min_ts, max("timestamp") AS max_ts, count(*) AS rows,
       count(DISTINCT "timestamp") AS unique_hours
FROM obs GROUP BY city_id"""
    )
)
def bitmap_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return bitmaps.coverage(_bitmaps(spark, folder))


@register(
    with_tables(
        """, hours AS (
  SELECT city_id, "timestamp", lead("timestamp") OVER (PARTITION BY city_id ORDER BY "timestamp") AS next
  FROM (SELECT DISTINCT city_id, "timestamp" FROM obs))
SELECT city_id, "timestamp" + INTERVAL 1 HOUR AS gap_start, next - INTERVAL 1 HOUR AS gap_end,
       date_diff('hour', "timestamp", next) - 1 AS missing
FROM hours WHERE next > "timestamp" + INTERVAL 1 HOUR"""
    )
)
def missing_hours(spark: SparkSession, folder: str) -> DataFrame:
    return bitmaps.missing_hours(_bitmaps(spark, folder))


def _with_gaps(rows: DataFrame) -> DataFrame:
    """Observations with NULLs: each measure is missing on its own share of rows."""
    missing = {
        m: F.when(F.col("event_id") % (i + 5) != 0, F.col(m)) for i, m in enumerate(MEASURES)
    }
    return rows.withColumns(missing)


_GAPS = ", gaps AS (SELECT event_id, city_id, \"timestamp\", " + ", ".join(
    f"CASE WHEN event_id % {i + 5} <> 0 THEN {m} END AS {m}" for i, m in enumerate(MEASURES)
) + " FROM obs)"
_NULLS = ", ".join(
    f"count(*) FILTER (WHERE {m} IS NULL) AS {'temp' if m == 'temperature' else m}_nulls"
    for m in MEASURES
)
_SHORT = {"temperature": "temp", "precipitation": "precip"}
_RANGES = ", ".join(
    f"{f}({m}) AS {f}_{_SHORT.get(m, m)}" for m in MEASURES for f in ("min", "max")
)


@register(with_tables(f"{_GAPS} SELECT city_id, {_NULLS} FROM gaps GROUP BY city_id"))
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.null_profile(_with_gaps(observations(spark, folder)))


@register(with_tables(f" SELECT city_id, {_RANGES} FROM obs GROUP BY city_id"))
def sanity_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.sanity_ranges(observations(spark, folder))


@register(
    with_tables(
        f"""{_GAPS} SELECT city_id, min("timestamp") AS min_ts, max("timestamp") AS max_ts,
  count(DISTINCT "timestamp") AS unique_hours, count(*) AS rows, {_NULLS}, {_RANGES}
FROM gaps GROUP BY city_id"""
    )
)
def full_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.full_profile(_with_gaps(observations(spark, folder)))


@register(
    with_tables(
        """
SELECT city_id, "timestamp", count(*) AS cnt FROM obs
GROUP BY city_id, "timestamp" HAVING count(*) > 1"""
    )
)
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.duplicate_keys(observations(spark, folder))


@register(
    with_tables(
        """
SELECT count(*) AS n_rows, count(DISTINCT city_id) AS n_series,
       min("timestamp") AS date_range_from, max("timestamp") AS date_range_to FROM latest"""
    )
)
def dataset_extent(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.extent(latest(spark, folder))


_NOT_NULL = " UNION ALL ".join(
    f"SELECT 'observations' AS table_name, '{m}' AS column_name, 'not_null' AS test, "
    f"count(*) FILTER (WHERE {m} IS NULL) AS failing_rows FROM gaps"
    for m in MEASURES
)


@register(with_tables(f"{_GAPS} {_NOT_NULL}"))
def not_null_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_null(_with_gaps(observations(spark, folder)), "observations", MEASURES)


@register(
    with_tables(
        """, keyed AS (
  SELECT md5(city_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key FROM obs
), keyed_latest AS (
  SELECT md5(city_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')) AS tech_key FROM latest)
SELECT 'raw' AS table_name, 'tech_key' AS column_name, 'unique' AS test, count(*) AS failing_rows
FROM (SELECT tech_key FROM keyed GROUP BY tech_key HAVING count(*) > 1)
UNION ALL
SELECT 'observations', 'tech_key', 'unique', count(*)
FROM (SELECT tech_key FROM keyed_latest GROUP BY tech_key HAVING count(*) > 1)"""
    )
)
def unique_check(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows repeat their key; keep-latest leaves it unique."""
    key = surrogate_key(F.col("city_id"), F.col("timestamp")).alias("tech_key")
    raw = observations(spark, folder).select(key)
    kept = latest(spark, folder).select(key)
    return checks.unique(raw, "raw", "tech_key").unionByName(
        checks.unique(kept, "observations", "tech_key")
    )


@register(
    """SELECT 'orders' AS table_name, 'o_custkey' AS column_name, 'relationships' AS test,
       count(*) AS failing_rows
FROM orders o ANTI JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT 'customer', 'c_nationkey', 'relationships', count(*)
FROM customer c ANTI JOIN nation n ON c.c_nationkey = n.n_nationkey
UNION ALL
SELECT 'events', 'city_id', 'relationships', count(*)
FROM (SELECT CAST(user_id % 30 AS INTEGER) AS city_id FROM events) e
ANTI JOIN nation n ON e.city_id = n.n_nationkey"""
)
def relationships_check(spark: SparkSession, folder: str) -> DataFrame:
    """Two checks that pass and one whose keys 25 to 29 have no parent."""
    orders, customer, nation = (
        table(spark, folder, name) for name in ("orders", "customer", "nation")
    )
    events = observations(spark, folder, series=30).select("city_id")
    return checks.union_all(
        [
            checks.relationships(orders, "orders", "o_custkey", customer, "c_custkey"),
            checks.relationships(customer, "customer", "c_nationkey", nation, "n_nationkey"),
            checks.relationships(events, "events", "city_id", nation, "n_nationkey"),
        ]
    )


@register(
    with_tables(
        """
SELECT city_id, "timestamp", temperature FROM latest ORDER BY city_id, "timestamp" LIMIT 5"""
    )
)
def head_sample(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.head(latest(spark, folder).select("city_id", "timestamp", "temperature"))
