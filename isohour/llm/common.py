"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

from isohour.session import materialise_at
from isohour.sources.tables import remove

#: The white space that separates words: space and the control characters tab to return.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
#: Shuffle files go when their query ends; else they stay until the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
Copy = Callable[[DataFrame, str], DataFrame]
_kept: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, made when first asked for. Workers outlive the stages they were started
    for, so a worker keeps one operator's at a time: what another one left goes first."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Let go of what an earlier stage left in this worker."""
    _kept.clear()


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their folder is."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def copied(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """A copy of ``df`` in the shared folder, and its path. Later reads need the copy alone, so the shuffle files go."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        return materialise_at(df, label)
    finally:
        conf.set(SHUFFLES_GO, before)


def fixed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder: computed once, and safe from lost executors."""
    return copied(df, label)[0]


@contextmanager
def passing(spark: SparkSession) -> Iterator[Copy]:
    """A ``fixed`` for tables that are read inside the block only; they are removed at its end."""
    paths: list[str] = []

    def held(df: DataFrame, label: str) -> DataFrame:
        made, path = copied(df, label)
        paths.append(path)
        return made

    try:
        yield held
    finally:
        for path in paths:
            remove(spark, path)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice holds about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
