from __future__ import annotations

import pytest
from helpers import at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.operators.dedup import keep_latest
from isohour.session import scratch_path
from isohour.sources import payload
from isohour.streaming import observations as live

KEYS = ("city_id", "timestamp")


def stream_of(spark, root):
    return live.parquet_stream(spark, root, schemas.RAW)


def add(spark, root, rows):
    raw(spark, rows).coalesce(1).write.mode("append").parquet(root)


def test_upsert_stream_equals_batch_over_several_runs(spark):
    root = scratch_path(spark, "up")
    for rows in (
        [(0, 1, 1.0, 1), (0, 1, 2.0, 3), (1, 2, 3.0, 1)],
        [(0, 1, 9.0, 2), (1, 2, 4.0, 2), (24 * 40, 1, 5.0, 1)],
        [],
        [(1, 2, 4.0, 2)],
    ):
        add(spark, f"{root}/in", rows)
        live.upsert_into(
            stream_of(spark, f"{root}/in"), f"{root}/out", f"{root}/ck", KEYS, "timestamp", "ingestion_ts"
        ).awaitTermination()
        batch = keep_latest(spark.read.schema(schemas.RAW).parquet(f"{root}/in"), KEYS)
        assert rows_of(spark.read.parquet(f"{root}/out"), *schemas.RAW.names) == rows_of(
            batch, *schemas.RAW.names
        )


def test_a_replayed_batch_changes_nothing(spark):
    root = scratch_path(spark, "replay")
    add(spark, f"{root}/in", [(0, 1, 1.0, 1), (1, 1, 2.0, 1)])
    for checkpoint in ("a", "b"):
        live.upsert_into(
            stream_of(spark, f"{root}/in"), f"{root}/out", f"{root}/{checkpoint}", KEYS, "timestamp", "ingestion_ts"
        ).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_latest_per_hour_waits_for_the_watermark(spark):
    root = scratch_path(spark, "latest")
    add(spark, f"{root}/in", [])
    rows = live.latest_per_hour(
        live.with_event_time(stream_of(spark, f"{root}/in")), schemas.MEASURES
    )
    add(spark, f"{root}/in", [(0, 1, 1.0, 1), (0, 1, 2.0, 3), (10, 1, 7.0, 1)])
    live.append_to(rows, f"{root}/out", f"{root}/ck").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 0
    # two days on: hour 0 is final, a correction of it comes in time with this batch
    add(spark, f"{root}/in", [(0, 1, 5.0, 4), (53, 1, 3.0, 1)])
    live.append_to(rows, f"{root}/out", f"{root}/ck").awaitTermination()
    assert rows_of(spark.read.parquet(f"{root}/out"), "timestamp", "temperature") == [(at(0), 5.0)]
    # hour 1 is too late now
    add(spark, f"{root}/in", [(1, 1, 5.0, 4), (80, 1, 3.0, 1)])
    live.append_to(rows, f"{root}/out", f"{root}/ck").awaitTermination()
    found = rows_of(spark.read.parquet(f"{root}/out"), "timestamp", "temperature")
    assert found == [(at(0), 5.0), (at(10), 7.0)]


@pytest.mark.parametrize("spread", [1, 4])
def test_repeats_are_dropped_across_batches(spark, spread):
    root = scratch_path(spark, "repeats")
    add(spark, f"{root}/in", [])
    rows = live.without_repeats(
        live.with_event_time(stream_of(spark, f"{root}/in")), [*KEYS, "ingestion_ts"], spread
    )
    for _ in range(2):
        for _ in range(5):
            add(spark, f"{root}/in", [(0, 1, 1.0, 1), (1, 1, 1.0, 1), (1, 1, 1.0, 2)])
        live.append_to(rows, f"{root}/out", f"{root}/ck").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 3


def test_daily_totals_are_updated(spark):
    root = scratch_path(spark, "daily")
    add(spark, f"{root}/in", [])
    rows = stream_of(spark, f"{root}/in")
    for more, want in (
        ([(0, 1, 1.0, 1), (5, 1, 3.0, 1)], [(at(0).date(), 2, 2.0)]),
        ([(6, 1, 5.0, 1), (30, 1, 9.0, 1)], [(at(0).date(), 3, 3.0), (at(24).date(), 1, 9.0)]),
        # hours pulled again count once, an older pull changes nothing, a late correction counts
        ([(6, 1, 5.0, 2), (6, 1, 8.0, 0), (30, 1, 9.0, 1)], [(at(0).date(), 3, 3.0), (at(24).date(), 1, 9.0)]),
        ([(24 * 40, 1, 0.0, 1)], [(at(0).date(), 3, 3.0), (at(24).date(), 1, 9.0), (at(24 * 40).date(), 1, 0.0)]),
        ([(0, 1, 4.0, 9)], [(at(0).date(), 3, 4.0), (at(24).date(), 1, 9.0), (at(24 * 40).date(), 1, 0.0)]),
    ):
        add(spark, f"{root}/in", more)
        live.daily_into(rows, f"{root}/latest", f"{root}/out", f"{root}/ck", scale=1).awaitTermination()
        assert rows_of(
            spark.read.parquet(f"{root}/out"), "observation_date", "rows", "avg_temperature"
        ) == want


def test_payload_stream(spark):
    root = scratch_path(spark, "land")
    rows = raw(spark, [(h, 1, float(h), 0) for h in range(5)])
    sound = payload.payload_of(rows, "city_id").select(F.col("body").alias("value"))
    for more, want in ((sound, (4, 0)), (spark.createDataFrame([("x",)], "value string"), (4, 1))):
        more.write.mode("append").text(f"{root}/landing")
        live.ingest_payloads(
            spark, f"{root}/landing", f"{root}/raw", f"{root}/refused", f"{root}/ck", f"{at(3)}"
        ).awaitTermination()
        refused = spark.read.parquet(f"{root}/refused")
        assert refused.columns == ["source_file", "series", "reason", "body", "refused_at"]
        assert (spark.read.parquet(f"{root}/raw").count(), refused.count()) == want
