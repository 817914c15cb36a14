from __future__ import annotations

import random

import pytest
from helpers import START, at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.plans import refresh
from isohour.session import scratch_path
from isohour.sources import payload, seeds, tables

MEASURED = [c for c in schemas.OBSERVATIONS.names if c not in ("update_ts", "ingestion_ts")]


def new_house(spark, grain="month"):
    house = refresh.Warehouse(scratch_path(spark, "house"), grain)
    seeds.cities(spark).write.parquet(house.dim_city)
    seeds.countries(spark).write.parquet(house.dim_country)
    return house


def feed(seed, days):
    """Raw rows of each day's run: the day before is pulled again, values may be corrected."""
    rng = random.Random(seed)
    for day in range(days):
        rows = []
        for h in range(max(0, (day - 1) * 24), (day + 1) * 24):
            for city in (1, 2, 3):
                if rng.random() < 0.8:
                    rows.append((h, city, round(rng.uniform(0, 30), 1), (day + 1) * 24))
        yield day, rows


@pytest.mark.parametrize("grain", ["month", "day"])
def test_incremental_runs_equal_a_full_refresh(spark, grain):
    step, whole = new_house(spark, grain), new_house(spark)
    for day, rows in feed(5, 4):
        as_of = f"{at((day + 1) * 24)}"
        for house in (step, whole):
            tables.append_raw(raw(spark, rows), house.raw_weather_hourly, grain=house.grain)
        refresh.refresh_observations(spark, step, as_of)
        # a daily look-back below the one of the observations would miss corrections
        refresh.refresh_marts(spark, step, as_of, lookback=refresh.Lookback(daily=2), scale=1)
    refresh.refresh_observations(spark, whole, as_of, full_refresh=True)
    refresh.refresh_marts(spark, whole, as_of, full_refresh=True, scale=1)
    for name in ("int_weather_observations", "mart_weather_hourly", "mart_weather_daily"):
        one = spark.read.parquet(f"{step.root}/{name}")
        two = spark.read.parquet(f"{whole.root}/{name}")
        columns = [c for c in two.columns if c not in ("update_ts", "ingestion_ts")]
        assert rows_of(one, *columns) == rows_of(two, *columns), name
    results = refresh.data_test_results(spark, step)
    assert results.count() == 40
    failing = {(r.table_name, r.test): r.failing_rows for r in results.collect() if r.failing_rows}
    assert failing == {}
    first_seen = spark.read.parquet(step.mart_weather_daily).groupBy("observation_date").agg(
        F.max("ingestion_ts").alias("seen"), F.max("update_ts").alias("updated")
    )
    assert rows_of(first_seen, "seen") == [(at(24 * (d + 1)),) for d in range(4)]
    assert {r.updated for r in first_seen.collect()} <= {at(24 * d) for d in range(2, 5)}


def test_default_daily_lookback_misses_the_oldest_correction(spark):
    """The daily look-back is a day shorter: a correction of that day waits for a full refresh."""
    house = new_house(spark)
    tables.append_raw(raw(spark, [(h, 1, 10.0, 60) for h in range(60)]), house.raw_weather_hourly)
    refresh.refresh_observations(spark, house, f"{at(60)}")
    refresh.refresh_marts(spark, house, f"{at(60)}")
    tables.append_raw(raw(spark, [(20, 1, 30.0, 61)]), house.raw_weather_hourly)
    as_of = f"{at(60)}"
    refresh.refresh_observations(spark, house, as_of)
    refresh.refresh_marts(spark, house, as_of)

    def highest(path):
        column = "temperature" if "hourly" in path else "max_temperature"
        return spark.read.parquet(path).agg(F.max(column)).first()[0]

    assert highest(house.mart_weather_hourly) == 30.0
    assert highest(house.mart_weather_daily) == 10.0
    refresh.refresh_marts(spark, house, as_of, full_refresh=True)
    assert highest(house.mart_weather_daily) == 30.0


def test_rows_beyond_the_lookback_wait_for_a_full_refresh(spark):
    house = new_house(spark)
    tables.append_raw(raw(spark, [(h, 1, 1.0, 96) for h in range(96)]), house.raw_weather_hourly)
    refresh.refresh_observations(spark, house, f"{at(96)}")
    tables.append_raw(raw(spark, [(0, 1, 50.0, 97), (95, 1, 60.0, 97)]), house.raw_weather_hourly)
    refresh.refresh_observations(spark, house, f"{at(97)}")
    hot = lambda: rows_of(
        spark.read.parquet(house.int_weather_observations).where("temperature > 1"), "temperature"
    )
    assert hot() == [(60.0,)]
    late = refresh.late_rows(spark.read.parquet(house.raw_weather_hourly), 2)
    assert rows_of(late.where("observation_date = DATE '2024-01-01'"), "late_rows") == [(25,)]
    refresh.refresh_observations(spark, house, f"{at(97)}", full_refresh=True)
    assert hot() == [(50.0,), (60.0,)]


def test_ingest_loads_archive_and_live_and_refuses_broken_documents(spark):
    house = new_house(spark)
    rows = raw(spark, [(h, city, float(h), 0) for h in range(30) for city in (1, 2)])
    bodies = [r.body for r in payload.payload_of(rows, "city_id").collect()]
    for landing, extra in (("live", ["{broken"]), ("archive", [])):
        spark.createDataFrame([(b,) for b in bodies + extra], "value string").write.text(
            f"{house.root}/{landing}"
        )
    as_of = f"{at(20)}"
    assert refresh.ingest(spark, house, f"{house.root}/live", as_of) == (42, 1)
    assert refresh.ingest(spark, house, f"{house.root}/archive", as_of, archive=True) == (60, 0)
    state = spark.read.parquet(house.ingestion_state).first()
    assert (state.pipeline, state.window_start, state.window_end) == (
        "weather_hourly_ingestion",
        START,
        at(20),
    )
    refused = spark.read.parquet(house.quarantine)
    assert rows_of(refused, "reason", "body") == [("malformed", "{broken")]
    refresh.refresh_observations(spark, house, as_of)
    refresh.refresh_marts(spark, house, as_of)
    assert spark.read.parquet(house.int_weather_observations).count() == 60
    by_table = {}
    for r in refresh.data_test_results(spark, house).collect():
        by_table.setdefault(r.table_name, []).append(r.failing_rows)
    assert set(by_table) == {
        "dim_city", "dim_country", "raw_weather_2years", "raw_weather_hourly", "stg_dim_city",
        "stg_dim_country", "stg_weather_2years", "stg_weather_hourly", "int_weather_observations",
        "mart_weather_daily", "mart_weather_hourly",
    }
    assert sum(map(sum, by_table.values())) == 0 and sum(map(len, by_table.values())) == 48


def test_all_cities_failing_leaves_the_state_alone(spark):
    house = new_house(spark)
    spark.createDataFrame([("oops",)], "value string").write.text(f"{house.root}/bad")
    assert refresh.ingest(spark, house, f"{house.root}/bad", f"{at(1)}") == (0, 1)
    assert tables.read(spark, house.ingestion_state) is None


def test_unknown_city_reaches_the_marts_once_and_fails_its_tests(spark):
    house = new_house(spark)
    tables.append_raw(raw(spark, [(0, 1, 1.0, 1), (0, 99, 2.0, 1)]), house.raw_weather_hourly)
    for _ in range(2):
        refresh.refresh_observations(spark, house, f"{at(2)}")
        refresh.refresh_marts(spark, house, f"{at(2)}")
    hourly = spark.read.parquet(house.mart_weather_hourly)
    assert rows_of(hourly, "city", "temperature") == [("Madrid", 1.0), (None, 2.0)]
    failing = {
        (r.table_name, r.column_name): r.failing_rows
        for r in refresh.data_test_results(spark, house).collect()
        if r.failing_rows
    }
    assert failing["int_weather_observations", "city_id"] == 1
    assert failing["mart_weather_hourly", "city"] == 1


def test_warehouse_paths():
    house = refresh.Warehouse("/x")
    assert house.mart_weather_daily == "/x/mart_weather_daily"
    with pytest.raises(AttributeError):
        house._private
