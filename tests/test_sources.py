from __future__ import annotations

import json

import pytest
from helpers import at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.functions.measures import nan_to_null
from isohour.session import materialise, scratch_path, shared_folder
from isohour.sources import payload, seeds, state, tables

LOADED = "2024-01-02 00:00:00"


def document(city=1, **changes):
    hourly = {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00"],
        "temperature_2m": [1.5, None],
        "wind_speed_10m": [3, 4],
        "wind_gusts_10m": [5.0, 6.0],
        "precipitation": [0.0, 0.2],
        "relative_humidity_2m": [80, 81],
        "pressure_msl": [1010.0, 1011.0],
    }
    hourly.update(changes)
    return json.dumps({"city_id": city, "hourly": {k: v for k, v in hourly.items() if v is not None}})


def parsed(spark, *bodies):
    return payload.parse(spark.createDataFrame([(b,) for b in bodies], "body string"))


def test_arrays_become_rows(spark):
    rows = payload.to_rows(parsed(spark, document()), LOADED)
    assert rows.schema.simpleString() == schemas.RAW.simpleString()
    assert rows_of(rows, "timestamp", "city_id", "temperature", "humidity") == [
        (at(0), 1, 1.5, 80.0),
        (at(1), 1, None, 81.0),
    ]
    assert {r.ingestion_ts for r in rows.collect()} == {at(24)}


@pytest.mark.parametrize(
    "body, reason",
    [
        ('{"city_id": 1, "hourly": {"time": ["2024', "malformed"),
        ("not json", "malformed"),
        (document(city=None), "no_series"),
        (document(pressure_msl=None), "missing_field"),
        (document(precipitation=[0.1]), "ragged_arrays"),
        (document(time=["2024-01-01T00:00", "yesterday"]), "bad_time"),
        ('{"city_id": 1}', "missing_field"),
    ],
)
def test_broken_document_is_refused_whole(spark, body, reason):
    found = parsed(spark, body, document(city=2))
    assert rows_of(payload.quarantined(found), "reason", "body") == [(reason, body)]
    assert {r.city_id for r in payload.to_rows(found, LOADED).collect()} == {2}


def test_empty_arrays_load_nothing(spark):
    found = parsed(spark, document(**{k: [] for k in ("time", *schemas.PAYLOAD_FIELDS)}))
    assert payload.quarantined(found).count() == 0
    assert payload.to_rows(found, LOADED).count() == 0


def test_folder_names_the_series(spark):
    root = scratch_path(spark, "landing")
    for city in (3, 4):
        body = json.dumps({"hourly": json.loads(document())["hourly"]})
        spark.createDataFrame([(body,)], "value string").write.text(f"{root}/city_id={city}")
    documents = payload.landed(spark, root)
    assert documents.where(F.col("source_file").contains("city_id=3")).count() == 1
    rows = payload.to_rows(payload.parse(documents), LOADED)
    assert {r.city_id for r in rows.collect()} == {3, 4}


def test_documents_that_span_lines(spark):
    root = scratch_path(spark, "pretty")
    body = json.dumps(json.loads(document()), indent=2)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(root)
    assert payload.quarantined(payload.parse(payload.landed(spark, root))).count() > 1
    rows = payload.to_rows(payload.parse(payload.landed(spark, root, whole_files=True)), LOADED)
    assert rows.count() == 2


def test_payload_round_trip(spark):
    rows = raw(spark, [(0, 1, 5.0, 24), (1, 1, None, 24), (0, 2, 7.5, 24)])
    back = payload.to_rows(payload.parse(payload.payload_of(rows, "city_id").select("body")), LOADED)
    assert rows_of(back, *schemas.RAW.names) == rows_of(rows, *schemas.RAW.names)


def test_future_rows_are_dropped(spark):
    rows = raw(spark, [(0, 1, 1.0, 0), (1, 1, 2.0, 0), (2, 1, 3.0, 0)])
    kept = payload.drop_future(rows, "2024-01-01 01:00:00")
    assert rows_of(kept, "temperature") == [(1.0,), (2.0,)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert rows_of(nan_to_null(df, ["x"]), "x") == [(1.0,), (None,), (None,)]


def test_append_keeps_duplicates_and_stamps_load_time(spark):
    path = scratch_path(spark, "raw")
    rows = raw(spark, [(0, 1, 1.0, 0), (800, 1, 2.0, 0)])
    tables.append_raw(rows, path)
    tables.append_raw(rows.drop("ingestion_ts"), path, loaded_at=LOADED)
    tables.append_raw(rows.drop("ingestion_ts"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    assert {r.ym for r in stored.select("ym").collect()} == {202401, 202402}
    assert stored.where("ingestion_ts IS NULL").count() == 0
    assert stored.where(F.col("ingestion_ts") == F.lit(LOADED).cast("timestamp_ntz")).count() == 2


def test_missing_table_reads_as_none(spark):
    assert tables.read(spark, scratch_path(spark, "absent")) is None


def test_create_table_with_default_and_comments(spark):
    name = "isohour_test.raw_t"
    tables.create_database(spark, "isohour_test")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    where = scratch_path(spark, "ddl")
    for _ in range(2):
        tables.create_table(spark, name, schemas.RAW, "ym", load_time="ingestion_ts", location=where)
    spark.sql(
        f"INSERT INTO {name} (timestamp, city_id, ym) "
        "VALUES (TIMESTAMP_NTZ '2024-01-01 00:00:00', 1, 202401)"
    )
    row = spark.table(name).first()
    assert row.ingestion_ts is not None and row.temperature is None
    notes = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert notes["temperature"] == schemas.DESCRIPTIONS["temperature"]


def test_describe_columns_and_builds(spark):
    rows = raw(spark, [(0, 1, 1.0, 0)])
    assert tables.build(rows, "some_view").count() == 1
    tables.create_database(spark, "isohour_test")
    spark.sql("DROP TABLE IF EXISTS isohour_test.built")
    built = tables.build(rows, "isohour_test.built", "table")
    assert built.count() == 1
    notes = {r.col_name: r.comment for r in spark.sql("DESCRIBE isohour_test.built").collect()}
    assert notes["pressure"] == schemas.DESCRIPTIONS["pressure"]
    spark.sql("DROP TABLE isohour_test.built")
    with pytest.raises(ValueError):
        tables.build(rows, "x", "other")


def test_month_predicate_prunes_partitions(spark):
    from isohour.functions.times import instant, since

    path = scratch_path(spark, "pruned")
    rows = raw(spark, [(h, 1, 1.0, 0) for h in range(0, 24 * 120, 24)])
    tables.append_raw(rows, path)
    kept = since(spark.read.parquet(path), "timestamp", instant("2024-03-10"), instant("2024-03-20"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ym" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp" in plan
    assert kept.count() == 11


def test_seeds(spark):
    joined = seeds.cities(spark).join(seeds.countries(spark), "country_id")
    assert joined.count() == 4
    assert {r.country_name for r in joined.collect()} == {"Spain"}


def test_state_keeps_one_row_per_pipeline_and_skips_empty_runs(spark):
    path = scratch_path(spark, "state")
    rows = raw(spark, [(0, 1, 1.0, 0), (5, 1, 2.0, 0)])
    assert state.record(rows, path, "hourly", LOADED)
    assert state.record(rows, path, "other", LOADED)
    assert state.record(rows.where("temperature = 2"), path, "hourly", "2024-01-03 00:00:00")
    assert not state.record(rows.limit(0), path, "hourly", "2024-01-04 00:00:00")
    found = rows_of(
        spark.read.parquet(path), "pipeline", "last_successful_run", "window_start", "rows_loaded"
    )
    assert found == [("hourly", at(48), at(5), 1), ("other", at(24), at(0), 2)]


def test_shared_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert materialise(spark.range(3), "ids").count() == 3
