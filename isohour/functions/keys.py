"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*parts: Column) -> Column:
    """md5 over the text forms joined by ``|``; NULL when any part is NULL.

    Text forms: ints in decimal, dates as yyyy-MM-dd, times as yyyy-MM-dd HH:mm:ss.
    """
    texts: list[Column] = []
    for part in parts:
        if texts:
            texts.append(F.lit("|"))
        texts.append(part.cast("string"))
    return F.md5(F.concat(*texts))


def compact_key(*parts: Column) -> Column:
    """A 64-bit key for joins inside Spark: half the width of md5, no equal elsewhere."""
    return F.xxhash64(*parts)
