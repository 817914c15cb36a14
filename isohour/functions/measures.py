"""Measures: gaps, labels and means that do not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec


def nan_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn NaN into NULL, once, at ingest: NaN poisons sums and compares as greatest."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def rained(precipitation: Column) -> Column:
    """1 where precipitation is above zero, else 0; a missing value counts as dry."""
    return F.when(precipitation > 0, 1).otherwise(0)


def total(value: Column, scale: int | None = None) -> Column:
    """Sum, NULL on no values.

    With ``scale`` the values are added as decimals of that many digits. Such a sum is the same
    whatever the partitioning or the order tasks finish in; use it for measures recorded with a
    known number of digits. Without ``scale`` it is the plain sum of doubles.
    """
    if scale is None:
        return F.sum(value)
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def mean(value: Column, scale: int | None = None) -> Column:
    """Mean of the non-NULL values; ``scale`` as in :func:`total`."""
    if scale is None:
        return F.avg(value)
    return F.try_divide(total(value, scale), F.count(value))


def trailing_mean(
    value: Column,
    rows: int,
    window: WindowSpec,
    scale: int | None = None,
    by_range: bool = False,
) -> Column:
    """Mean of the non-NULL values in the ``rows`` rows before the current one.

    With ``by_range`` ``rows`` is a distance in the order of the window instead.

    Without ``scale`` each frame is averaged afresh. With it the values are counted in whole
    units of the last digit; a difference of two running sums is then exact, and its cost does
    not grow with ``rows``.
    """
    frame = window.rangeBetween if by_range else window.rowsBetween
    if scale is None:
        return F.avg(value).over(frame(-rows, -1))

    def up_to(end: int, of: Column) -> Column:
        summed = F.sum(of).over(frame(Window.unboundedPreceding, end))
        return F.coalesce(summed, F.lit(0))

    units = (value.cast(f"decimal(18,{scale})") * F.lit(10**scale)).cast("bigint")
    present = value.isNotNull().cast("bigint")
    added = up_to(-1, units) - up_to(-1 - rows, units)
    counted = up_to(-1, present) - up_to(-1 - rows, present)
    return F.try_divide(added / F.lit(10**scale), counted)
