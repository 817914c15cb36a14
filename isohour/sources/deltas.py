"""Keep-latest tables for streams: a snapshot laid out by day plus one small folder per micro-batch.

A micro-batch is written once and nothing is read for it. Readers put the rows of the touched days
together with the deltas; days without a delta come straight from the snapshot, without a shuffle.
:func:`compact` folds deltas into the snapshot, which changes no reader's result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from isohour.operators.dedup import keep_latest
from isohour.operators.upsert import folders_of, merge_latest, upsert
from isohour.sources import tables

GRAIN = "day"


def run_name(checkpoint: str) -> str:
    """Names the deltas of one stream, so that streams into one table keep theirs apart."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def add(rows: DataFrame, path: str, run: str, number: int, ts: str) -> None:
    """Store a micro-batch; a replay writes the same folder again.

    Few files, each sorted by time, so that readers of some days skip most of it by statistics.
    """
    sorted_rows = rows.hint("rebalance").sortWithinPartitions(ts)
    sorted_rows.write.mode("overwrite").parquet(f"{path}/delta/run={run}/batch={number}")


def waiting(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of all deltas that are still there."""
    stored = tables.read(spark, f"{path}/delta")
    return None if stored is None else stored.drop("run", "batch")


def read(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    ts: str,
    latest: str,
    days: Sequence[int | None] | None = None,
) -> DataFrame | None:
    """The latest row per key, of all days or of the given ones (yyyymmdd, None for no time).

    None before the first write.
    """
    snapshot, deltas = tables.read(spark, f"{path}/snapshot"), waiting(spark, path)
    if deltas is not None and days is not None:
        deltas = tables.of_days(deltas, ts, days)
    if snapshot is not None and days is not None:
        snapshot = tables.in_folders(snapshot, days)
    if deltas is None:
        return None if snapshot is None else tables.without_folders(snapshot)
    if snapshot is None:
        return keep_latest(deltas, keys, latest)
    columns = tables.without_folders(snapshot).columns
    if days is not None:
        return merge_latest(snapshot.select(*columns), deltas.select(*columns), keys, latest)
    touched = folders_of(deltas, ts, GRAIN)
    merged = merge_latest(
        tables.in_folders(snapshot, touched).select(*columns), deltas.select(*columns), keys, latest
    )
    return tables.outside_folders(snapshot, touched).select(*columns).unionByName(merged)


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], ts: str, latest: str, keep: int = 0
) -> list[int | None]:
    """Fold all deltas into the snapshot; returns the days rewritten.

    Folding again changes nothing, so a run that dies between fold and removal does no harm.
    ``keep`` leaves the newest deltas of each stream, for readers that have already listed them.
    """
    folders = {run: tables.children(spark, run) for run in tables.children(spark, f"{path}/delta")}
    deltas = waiting(spark, path)
    touched: list[int | None] = []
    if deltas is not None:

        def merge(target: DataFrame, batch: DataFrame, by: Sequence[str]) -> DataFrame:
            return merge_latest(target, batch, by, latest)

        rows = keep_latest(deltas, keys, latest)
        touched = upsert(spark, f"{path}/snapshot", rows, keys, ts, grain=GRAIN, merge=merge)
    for batches in folders.values():
        ordered = sorted(batches, key=lambda folder: int(folder.rsplit("=", 1)[-1]))
        for folder in ordered[: len(ordered) - keep]:
            tables.remove(spark, folder)
    return touched
