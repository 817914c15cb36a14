from __future__ import annotations

import pytest
from helpers import at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.operators.dedup import keep_latest
from isohour.session import scratch_path
from isohour.sources import deltas, tables
from isohour.streaming import observations as live

KEYS = ("city_id", "timestamp")
BATCHES = (
    [(0, 1, 1.0, 1), (1, 2, 3.0, 1), (30, 1, 7.0, 1)],
    [(0, 1, 9.0, 0), (1, 2, 4.0, 2), (24 * 40, 1, 5.0, 1)],  # older, corrected, new
    [(1, 2, 4.0, 2)],  # pulled again
    [(30, 1, 8.0, 90)],  # a late correction
)


def read(spark, path, days=None):
    return deltas.read(spark, path, KEYS, "timestamp", "ingestion_ts", days)


def compact(spark, path, keep=0):
    return deltas.compact(spark, path, KEYS, "timestamp", "ingestion_ts", keep)


@pytest.mark.parametrize("compacted", [(), (0, 2), (0, 1, 2, 3)])
def test_every_state_of_the_table_reads_like_the_batch_result(spark, compacted):
    path = scratch_path(spark, "deltas")
    assert read(spark, path) is None
    seen = []
    for number, rows in enumerate(BATCHES):
        seen += rows
        for _ in range(2):  # a replay writes the same folder
            deltas.add(keep_latest(raw(spark, rows), KEYS), path, "r", number, "timestamp")
        if number in compacted:
            compact(spark, path)
            assert deltas.waiting(spark, path) is None
        whole = keep_latest(raw(spark, seen), KEYS)
        assert rows_of(read(spark, path), *schemas.RAW.names) == rows_of(whole, *schemas.RAW.names)
        first = whole.where("timestamp < TIMESTAMP_NTZ '2024-01-02'")
        assert rows_of(read(spark, path, [20240101]), *KEYS, "temperature") == rows_of(first, *KEYS, "temperature")


def test_rows_without_a_time_are_kept_and_replaced(spark):
    path = scratch_path(spark, "timeless")
    rows = raw(spark, [(0, 1, 1.0, 1), (1, 1, 2.0, 1)])
    for number, t in enumerate((5.0, 6.0)):
        untimed = rows.limit(1).withColumns(
            {"timestamp": F.lit(None).cast("timestamp_ntz"), "temperature": F.lit(t), "ingestion_ts": F.lit(at(number))}
        ).select(rows.columns)
        deltas.add(rows.unionByName(untimed), path, "r", number, "timestamp")
        assert rows_of(read(spark, path), "temperature") == [(1.0,), (2.0,), (t,)]
        assert rows_of(read(spark, path, [None]), "temperature") == [(t,)]
        assert None in compact(spark, path)
        assert rows_of(read(spark, path), "temperature") == [(1.0,), (2.0,), (t,)]


def test_streams_keep_their_deltas_apart_and_the_newest_can_stay(spark):
    path = scratch_path(spark, "apart")
    assert deltas.run_name("a") != deltas.run_name("b")
    for run in ("a", "b"):
        for number in range(12):
            deltas.add(raw(spark, [(number, 1 if run == "a" else 2, 1.0, 1)]), path, run, number, "timestamp")
    compact(spark, path, keep=2)
    left = {f.rsplit("=", 1)[-1] for f in tables.children(spark, f"{path}/delta/run=a")}
    assert left == {"10", "11"}
    assert read(spark, path).count() == 24
    assert compact(spark, path) == [20240101] and read(spark, path).count() == 24
    assert compact(spark, path) == []


def test_a_fold_that_dies_before_the_removal_does_no_harm(spark, monkeypatch):
    path = scratch_path(spark, "fold")
    for number, rows in enumerate(BATCHES):
        deltas.add(keep_latest(raw(spark, rows), KEYS), path, "r", number, "timestamp")
    before = rows_of(read(spark, path), *schemas.RAW.names)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "remove", die)
        with pytest.raises(RuntimeError):
            compact(spark, path)
    for _ in range(2):
        assert rows_of(read(spark, path), *schemas.RAW.names) == before
        compact(spark, path)


def test_days_without_a_delta_are_not_shuffled(spark):
    path = scratch_path(spark, "pruned")
    deltas.add(raw(spark, [(h, 1, 1.0, 1) for h in range(0, 240, 6)]), path, "r", 0, "timestamp")
    compact(spark, path)
    deltas.add(raw(spark, [(30, 1, 2.0, 2)]), path, "r", 1, "timestamp")
    found = read(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    through, merged = plan.split("Window", 1)
    assert "PartitionFilters" in through and "Exchange" not in through
    assert "PartitionFilters" in merged and "Exchange" in merged
    assert found.count() == 40 and found.where("temperature = 2").count() == 1


@pytest.mark.parametrize("every", [None, 1, 2])
def test_streams_with_a_replay_and_a_late_correction(spark, every):
    root = scratch_path(spark, "stream")
    raw(spark, []).write.parquet(f"{root}/in")
    rows = live.parquet_stream(spark, f"{root}/in", schemas.RAW)
    hours = live.latest_per_hour(live.with_event_time(rows, lateness="50 days"), schemas.MEASURES)
    for more in BATCHES:
        raw(spark, more).coalesce(1).write.mode("append").parquet(f"{root}/in")
        live.latest_into(
            hours, f"{root}/hours", f"{root}/ck-hours", KEYS, "timestamp", compact_every=every
        ).awaitTermination()
        live.daily_into(
            rows, f"{root}/latest", f"{root}/daily", f"{root}/ck-daily", scale=1, compact_every=every
        ).awaitTermination()
        whole = keep_latest(spark.read.schema(schemas.RAW).parquet(f"{root}/in"), KEYS)
        want = rows_of(whole, *schemas.RAW.names)
        assert rows_of(read(spark, f"{root}/hours"), *schemas.RAW.names) == want
        assert rows_of(read(spark, f"{root}/latest"), *schemas.RAW.names) == want
        totals = live.daily_totals(whole, scale=1)
        stored = spark.read.parquet(f"{root}/daily").select(totals.columns)
        assert rows_of(stored, *totals.columns) == rows_of(totals, *totals.columns)
    # all of it again, under another checkpoint
    live.daily_into(
        rows, f"{root}/latest", f"{root}/daily", f"{root}/ck-again", scale=1, compact_every=every
    ).awaitTermination()
    assert rows_of(read(spark, f"{root}/latest"), *schemas.RAW.names) == want
    assert rows_of(spark.read.parquet(f"{root}/daily"), *totals.columns) == rows_of(totals, *totals.columns)
