from __future__ import annotations

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from isohour.session import scratch_path
from isohour.sources import generations, tables


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n bigint")


def test_only_the_part_is_replaced(spark):
    path = scratch_path(spark, "parts")
    assert generations.read(spark, path, "part") is None
    generations.replace(numbers(spark, 1, 2), path, "part", "a")
    generations.replace(numbers(spark, 3), path, "part", "b")
    generations.replace(numbers(spark, 4), path, "part", "a")
    assert rows_of(generations.read(spark, path, "part"), "part", "n") == [("a", 4), ("b", 3)]
    assert rows_of(generations.read(spark, path, "part", ["b"]), "n") == [(3,)]
    assert generations.read(spark, path, "part", ["c"]) is None
    generations.replace(numbers(spark).limit(0), path, "part", "b")
    assert rows_of(generations.read(spark, path, "part"), "part", "n") == [("a", 4)]


def test_a_write_that_dies_leaves_the_old_rows(spark):
    path = scratch_path(spark, "dies")
    generations.replace(numbers(spark, 1, 2), path, "part", "a")
    poisoned = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("n")
    )
    with pytest.raises(Exception, match="lost"):
        generations.replace(poisoned, path, "part", "a")
    assert rows_of(generations.read(spark, path, "part"), "n") == [(1,), (2,)]
    generations.replace(numbers(spark, 7), path, "part", "a")
    assert rows_of(generations.read(spark, path, "part"), "n") == [(7,)]


def test_a_switch_that_dies_leaves_the_old_rows(spark, monkeypatch):
    """The new rows are there, the pointer is not; the next write removes them."""
    path = scratch_path(spark, "switch")
    generations.replace(numbers(spark, 1), path, "part", "a")
    with monkeypatch.context() as patched:
        patched.setattr(generations, "POINTER", "no schema at all")
        with pytest.raises(Exception):
            generations.replace(numbers(spark, 2), path, "part", "a")
    assert len(tables.children(spark, f"{path}/rows/part=a")) == 2
    assert rows_of(generations.read(spark, path, "part"), "n") == [(1,)]
    generations.replace(numbers(spark, 3), path, "part", "a")
    assert rows_of(generations.read(spark, path, "part"), "n") == [(3,)]
    assert len(tables.children(spark, f"{path}/rows/part=a")) == 2


def test_readers_of_the_former_generation_finish_and_older_ones_go(spark):
    path = scratch_path(spark, "readers")
    generations.replace(numbers(spark, 1), path, "part", "a")
    reading = generations.read(spark, path, "part")
    generations.replace(numbers(spark, 2), path, "part", "a")
    assert rows_of(reading, "n") == [(1,)]
    for n in (3, 4, 5):
        generations.replace(numbers(spark, n), path, "part", "a")
        assert len(tables.children(spark, f"{path}/rows/part=a")) == 2
    assert rows_of(generations.read(spark, path, "part"), "n") == [(5,)]


def test_children_and_remove(spark):
    path = scratch_path(spark, "children")
    assert tables.children(spark, path) == []
    tables.remove(spark, path)
    numbers(spark, 1).write.parquet(f"{path}/x")
    assert tables.children(spark, path) == [f"{path}/x"]
    tables.remove(spark, f"{path}/x")
    assert tables.children(spark, path) == []
