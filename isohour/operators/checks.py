"""Declarative data tests: not_null, unique and relationships, one result row per test."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

RESULT = "table_name string, column_name string, test string, failing_rows bigint"


@dataclass(frozen=True)
class Rules:
    """The data tests of one table. ``relationships``: column -> (parent table, parent column)."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    relationships: Mapping[str, tuple[str, str]] | None = None


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column: all columns of a table in one pass, unpivoted to rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failing_rows").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("test"), "failing_rows"
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are left to not_null."""
    repeated = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    )
    return _result(repeated, table, column, "unique")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Orphaned rows. Child keys are counted before the join, so a hot key joins as one row."""
    keys = child.groupBy(column).agg(F.count("*").alias("n"))
    lost = orphans(keys, column, parent, parent_column)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("relationships").alias("test"),
        "failing_rows",
    )


def _result(failing: DataFrame, table: str, column: str, test: str) -> DataFrame:
    return failing.agg(F.count("*").alias("failing_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        "failing_rows",
    )


def run(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """All tests whose table is present, as one DataFrame."""
    results: list[DataFrame] = []
    for name, rule in rules.items():
        df = tables.get(name)
        if df is None:
            continue
        if rule.not_null:
            results.append(not_null(df, name, rule.not_null))
        results.extend(unique(df, name, c) for c in rule.unique)
        for column, (parent, parent_column) in (rule.relationships or {}).items():
            results.append(relationships(df, name, column, tables[parent], parent_column))
    return union_all(results)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# The data tests of the warehouse layers.
_RAW = Rules(("timestamp", "city_id"), (), {"city_id": ("dim_city", "city_id")})
WAREHOUSE_RULES: dict[str, Rules] = {
    "dim_city": Rules(
        ("city_id", "city_name", "latitude", "longitude", "country_id"),
        ("city_id",),
        {"country_id": ("dim_country", "country_id")},
    ),
    "dim_country": Rules(("country_id", "country_name"), ("country_id",)),
    "raw_weather_2years": _RAW,
    "raw_weather_hourly": _RAW,
    "stg_dim_city": Rules(
        ("city_id", "city_name", "country_id"),
        ("city_id",),
        {"country_id": ("stg_dim_country", "country_id")},
    ),
    "stg_dim_country": Rules(("country_id", "country_name"), ("country_id",)),
    "stg_weather_2years": Rules(
        ("timestamp", "city_id", "tech_key"),
        ("tech_key",),
        {"city_id": ("stg_dim_city", "city_id")},
    ),
    "stg_weather_hourly": Rules(
        ("timestamp", "city_id", "tech_key"), (), {"city_id": ("stg_dim_city", "city_id")}
    ),
    "int_weather_observations": Rules(
        ("timestamp", "city_id", "tech_key"),
        ("tech_key",),
        {"city_id": ("stg_dim_city", "city_id")},
    ),
    "mart_weather_daily": Rules(
        ("observation_date", "city", "country", "tech_key"), ("tech_key",)
    ),
    "mart_weather_hourly": Rules(
        ("observation_timestamp", "city", "country", "tech_key"), ("tech_key",)
    ),
}
