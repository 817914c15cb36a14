"""Named queries over the driver tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from isohour.plans.catalogue import layers, modelling, quality, serving, streams, tables, warehouse
from isohour.plans.catalogue.registry import Query

QUERIES: dict[str, Query] = {}
for _module in (tables, layers, quality, modelling, serving, streams, warehouse):
    QUERIES.update(_module.register.found)

__all__ = ["QUERIES", "Query"]
