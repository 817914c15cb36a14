"""A decorator that collects a module's queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Register:
    def __init__(self) -> None:
        self.found: dict[str, Query] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Run], Run]:
        def add(run: Run) -> Run:
            self.found[run.__name__] = Query(run, sql)
            return run

        return add
