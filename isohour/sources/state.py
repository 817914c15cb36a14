"""Pipeline state: one row per pipeline, in a folder of its own."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from isohour.functions.times import instant


SCHEMA = "last_successful_run timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz, rows_loaded bigint"


def window() -> list[Column]:
    """First and last time and number of rows of a batch."""
    return [
        F.min("timestamp").alias("window_start"),
        F.max("timestamp").alias("window_end"),
        F.count("*").alias("rows_loaded"),
    ]


def batch_state(batch: DataFrame, pipeline: str, as_of: str | Column) -> DataFrame:
    """The state row a batch leaves behind; no row when the batch is empty."""
    return (
        batch.agg(*window())
        .where("rows_loaded > 0")
        .select(
            F.lit(pipeline).alias("pipeline"),
            instant(as_of).alias("last_successful_run"),
            "window_start",
            "window_end",
            "rows_loaded",
        )
    )


def record(batch: DataFrame, path: str, pipeline: str, as_of: str | Column) -> bool:
    """Replace the pipeline's row. A run that loaded nothing leaves the last good one."""
    found = batch.agg(*window()).first().asDict()
    return record_window(batch.sparkSession, found, path, pipeline, as_of)


def record_window(
    spark: SparkSession, found: Mapping[str, Any], path: str, pipeline: str, as_of: str | Column
) -> bool:
    """The same from the values of :func:`window`, already collected."""
    if not found["rows_loaded"]:
        return False
    values = {k: F.lit(v) for k, v in found.items()} | {"last_successful_run": instant(as_of)}
    fields = T.StructType.fromDDL(SCHEMA).fields
    row = spark.range(1).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in fields])
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/pipeline={pipeline}")
    return True
