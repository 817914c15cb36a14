"""Replaceable parts of a table: rows are written aside and a pointer row then switches to them.

``<path>/rows/<part>=<value>/gen=<name>`` holds the rows of one write, ``<path>/pointer`` a log of
(value, gen, version). Readers resolve the highest version per value, so they see the old rows or
the new ones, whatever happens to the writer in between. One writer at a time per value.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.sources import tables

POINTER = "value string, gen string, version bigint"


def _current(spark: SparkSession, path: str) -> DataFrame | None:
    log = tables.read(spark, f"{path}/pointer")
    if log is None:
        return None
    newest = F.max_by(F.struct("gen", "version"), F.struct("version", "gen")).alias("_now")
    return log.groupBy("value").agg(newest).select("value", "_now.*")


def _folder(path: str, part: str, value: str) -> str:
    return f"{path}/rows/{part}={value}"


def replace(df: DataFrame, path: str, part: str, value: str) -> str:
    """Make ``df`` the rows of ``value``; an empty frame empties it. Returns the generation's name.

    The generation it replaces stays for readers that have already resolved it; older ones, and
    what a broken-off write left, are removed.
    """
    spark = df.sparkSession
    log = _current(spark, path)
    before = None if log is None else log.where(F.col("value") == value).first()
    gen = uuid.uuid4().hex
    df.write.parquet(f"{_folder(path, part, value)}/gen={gen}")
    row = (value, gen, 1 if before is None else before.version + 1)
    spark.createDataFrame([row], POINTER).coalesce(1).write.mode("append").parquet(f"{path}/pointer")
    kept = {f"gen={gen}"} | ({f"gen={before.gen}"} if before else set())
    for folder in tables.children(spark, _folder(path, part, value)):
        if folder.rsplit("/", 1)[-1] not in kept:
            tables.remove(spark, folder)
    return gen


def read(
    spark: SparkSession, path: str, part: str, values: Sequence[str] | None = None
) -> DataFrame | None:
    """The current rows with their part as a string column, or None before the first write.

    Only the current folders, and with ``values`` only theirs, are listed and read. The driver
    holds one pointer row per value.
    """
    log = _current(spark, path)
    if log is None:
        return None
    if values is not None:
        log = log.where(F.col("value").isin(list(values)))
    found = [f"{_folder(path, part, r.value)}/gen={r.gen}" for r in log.orderBy("value").collect()]
    if not found:
        return None
    stored = spark.read.option("basePath", f"{path}/rows").parquet(*found)
    return stored.withColumn(part, F.col(part).cast("string")).drop("gen")
