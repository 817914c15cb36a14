"""Keyed upserts: delete the batch's keys from the target, insert the batch, keep first-seen times."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isohour.functions.times import instant
from isohour.operators.dedup import keep_latest
from isohour.session import materialise_at
from isohour.sources import tables


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL matches NULL: rows of an unknown city replace each other too."""
    tests = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, tests)


def untouched(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch."""
    return target.alias("t").join(
        batch.select(*keys).alias("b"), _same_key("t", "b", keys), "left_anti"
    )


def replace_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete + insert."""
    return untouched(target, batch, keys).unionByName(batch)


def merge_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], latest: str = "ingestion_ts"
) -> DataFrame:
    """Keep the latest row per key of both sides. Replays and late batches change nothing."""
    return keep_latest(target.unionByName(batch), keys, latest)


def carry_first_seen(
    batch: DataFrame, target: DataFrame | None, keys: Sequence[str], as_of: str | Column
) -> DataFrame:
    """Add ``ingestion_ts``: the target's for a known key, the run's time for a new one."""
    if target is None:
        return batch.withColumn("ingestion_ts", instant(as_of))
    seen = target.groupBy(*keys).agg(F.min("ingestion_ts").alias("ingestion_ts"))
    return (
        batch.alias("b")
        .join(seen.alias("t"), _same_key("b", "t", keys), "left")
        .select("b.*", F.coalesce("t.ingestion_ts", instant(as_of)).alias("ingestion_ts"))
    )


def folders_of(batch: DataFrame, ts: str, grain: str = "month") -> list[int | None]:
    """The folders a batch touches: one number per calendar month or day, None for rows without a
    time."""
    rows = batch.select(tables.folder_key(F.col(ts), grain).alias("folder")).distinct().collect()
    return sorted((r.folder for r in rows), key=lambda f: (f is not None, f or 0))


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    as_of: str | Column | None = None,
    full_refresh: bool = False,
    keep_copy: bool = True,
    grain: str = "month",
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = replace_keys,
) -> list[int | None]:
    """Apply a batch to the Parquet table at ``path``; returns the folders written.

    Only the months or days the batch touches are read and rewritten; ``grain`` sets the layout
    of a new table. The first run writes its batch straight to the table. Later the batch is written
    to the shared folder first, since it is read several times and may itself be derived from the
    target. With ``keep_copy`` the merged folders are written there too before the table is changed:
    should the run die while folders are being swapped, they can be restored with
    ``tables.write_table(copy, path, ts, keys, "folders")``. Without it that write is saved. Copies are
    removed once the table is written.

    A full refresh swaps folders in as well and then removes those it has no rows for, so a run that
    dies while it writes leaves the old rows. Only where ``grain`` differs from the stored layout is
    the old table emptied first.

    Rows without a time share a folder and are kept or replaced by key like others. A full refresh
    with an empty batch leaves an empty table.

    With ``as_of`` the audit column ``ingestion_ts`` is carried over from the target.
    """
    target = tables.read(spark, path)
    if target is None:
        if as_of is not None:
            batch = carry_first_seen(batch, None, keys, as_of)
        tables.write_table(batch, path, ts, keys, "overwrite", grain)
        written = tables.read(spark, path)
        return [] if written is None else folders_of(written, ts, grain)
    batch, copy = materialise_at(batch, "batch")
    copies = [copy]
    if full_refresh:
        folders = folders_of(batch, ts, grain)
        if as_of is not None:
            batch = carry_first_seen(batch, None, keys, as_of)
        same = folders and tables.grain_of(target) == grain
        tables.write_table(batch, path, ts, keys, "folders" if same else "overwrite", grain)
        if same:
            tables.keep_folders(spark, path, folders, grain)
    else:
        grain = tables.grain_of(target)
        folders = folders_of(batch, ts, grain)
        touched = tables.without_folders(tables.in_folders(target, folders))
        if as_of is not None:
            batch = carry_first_seen(batch, touched, keys, as_of)
        if folders:
            merged = merge(touched, batch.select(*touched.columns), keys)
            if keep_copy:
                merged, copy = materialise_at(merged, "merged")
                copies.append(copy)
            tables.write_table(merged, path, ts, keys, "folders", grain)
    for copy in copies:
        tables.remove(spark, copy)
    return folders
