"""The hourly job: landed payloads -> raw -> observations -> marts -> data tests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import days_before, instant, month_key, since
from isohour.operators import checks
from isohour.operators.dedup import keep_latest, staged, union_sources
from isohour.operators.marts import daily_mart, hourly_mart
from isohour.operators.upsert import upsert
from isohour.session import materialise_at
from isohour.sources import payload, state, tables


@dataclass(frozen=True)
class Lookback:
    """Days re-read by an incremental run, per table. None of them with a full refresh.

    Observations look back to the second; the marts from the start of the day, so that whole
    days are recomputed. ``daily`` below ``observations`` leaves corrections of the oldest day
    out of the daily mart until a full refresh.
    """

    observations: int = 2
    hourly: int = 2
    daily: int = 1


@dataclass(frozen=True)
class Warehouse:
    """Paths of the tables under one root; ``grain`` is how finely new tables are laid out."""

    root: str
    grain: str = "day"

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def ingest(
    spark: SparkSession,
    house: Warehouse,
    landing: str,
    as_of: str,
    *,
    archive: bool = False,
    whole_files: bool = False,
    pipeline: str = "weather_hourly_ingestion",
) -> tuple[int, int]:
    """Load a landing folder into a raw table; returns rows loaded and documents refused.

    The parsed documents are the only copy; counts and the window of the state row come from it.
    The archive load keeps every hour; the live load drops hours after ``as_of``.
    """
    parsed, copy = materialise_at(payload.parse(payload.landed(spark, landing, whole_files)), "parsed")
    rows = payload.to_rows(parsed, as_of)
    if not archive:
        rows = payload.drop_future(rows, as_of)
    raw = house.raw_weather_2years if archive else house.raw_weather_hourly
    tables.append_raw(rows, raw, grain=house.grain)
    bad = payload.quarantined(parsed, as_of)
    bad.write.mode("append").parquet(house.quarantine)
    loaded, refused = rows.agg(*state.window()).first().asDict(), bad.count()
    if not archive:
        state.record_window(spark, loaded, house.ingestion_state, pipeline, as_of)
    tables.remove(spark, copy)
    return loaded["rows_loaded"], refused


def until(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Rows up to ``as_of``, so that a run for a past instant can be repeated; rows without a
    time stay."""
    return df.where(F.col(ts).isNull() | (F.col(ts) <= instant(as_of)))


def observation_batch(
    sources: list[DataFrame], as_of: str, lookback_days: int | None
) -> DataFrame:
    """Union of the raw sources, the look-back, keep-latest, keys and recompute time."""
    if lookback_days is not None:
        start = days_before(instant(as_of), lookback_days)
        sources = [since(df, "timestamp", start, instant(as_of)) for df in sources]
    stages = [staged(df) for df in sources]
    rows = stages[0]
    for other in stages[1:]:
        rows = union_sources(rows, other)
    latest = keep_latest(rows, ("city_id", "timestamp"))
    return latest.withColumn("update_ts", instant(as_of))


def refresh_observations(
    spark: SparkSession,
    house: Warehouse,
    as_of: str,
    *,
    full_refresh: bool = False,
    lookback: Lookback = Lookback(),
) -> list[int]:
    first_run = tables.read(spark, house.int_weather_observations) is None
    days = None if full_refresh or first_run else lookback.observations
    raw = [tables.read(spark, house.raw_weather_hourly), tables.read(spark, house.raw_weather_2years)]
    batch = observation_batch([df for df in raw if df is not None], as_of, days)
    return upsert(
        spark,
        house.int_weather_observations,
        batch,
        ("city_id", "timestamp"),
        "timestamp",
        full_refresh=full_refresh,
        grain=house.grain,
    )


def refresh_marts(
    spark: SparkSession,
    house: Warehouse,
    as_of: str,
    *,
    full_refresh: bool = False,
    lookback: Lookback = Lookback(),
    scale: int | None = None,
) -> None:
    observations = spark.read.parquet(house.int_weather_observations)
    city, country = spark.read.parquet(house.dim_city), spark.read.parquet(house.dim_country)
    marts = (
        (house.mart_weather_hourly, lookback.hourly, ("city", "observation_timestamp")),
        (house.mart_weather_daily, lookback.daily, ("city", "observation_date")),
    )
    for path, days, keys in marts:
        incremental = not full_refresh and tables.read(spark, path) is not None
        if incremental:
            start = days_before(instant(as_of), days, snap_to_day=True)
            rows = since(observations, "timestamp", start, instant(as_of))
        else:
            rows = until(observations, "timestamp", as_of)
        if path == house.mart_weather_hourly:
            batch = hourly_mart(rows, city, country, as_of)
        else:
            batch = daily_mart(rows, city, country, as_of, scale)
        upsert(
            spark,
            path,
            batch,
            keys,
            keys[1],
            as_of=as_of,
            full_refresh=full_refresh,
            grain=house.grain,
        )


def late_rows(raw: DataFrame, lookback_days: int) -> DataFrame:
    """Rows that arrive too late for an incremental run, per day of observation."""
    too_late = F.col("timestamp") < days_before(F.col("ingestion_ts"), lookback_days)
    return (
        raw.where(too_late)
        .groupBy(F.to_date("timestamp").alias("observation_date"))
        .agg(F.count("*").alias("late_rows"))
    )


def data_test_results(spark: SparkSession, house: Warehouse) -> DataFrame:
    """The data tests on every table of the warehouse that exists."""
    found: dict[str, DataFrame] = {}
    for name in checks.WAREHOUSE_RULES:
        base = {"stg_dim_city": "dim_city", "stg_dim_country": "dim_country"}.get(name, name)
        base = base.replace("stg_weather", "raw_weather")
        df = tables.read(spark, f"{house.root}/{base}")
        if df is not None:
            found[name] = staged(df) if name.startswith("stg_weather") else df
    return checks.run(found, checks.WAREHOUSE_RULES)


def month_partition_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows, first and last time per partition month."""
    return df.groupBy(month_key(F.col(ts)).alias("ym")).agg(
        F.count("*").alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )
