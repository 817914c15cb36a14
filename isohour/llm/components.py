"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from isohour.llm.common import fixed


def contracted(edges: DataFrame) -> DataFrame:
    """One round: every node's neighbours are linked to the smallest of them, then upwards neighbours to
    the smallest below. Minima are aggregated before they are joined back, so a node of very many links is
    not gathered in one place."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.col("b").alias("v"), "m", "a")
    return small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has a link. Edges are (a, b)."""
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, before = fixed(oriented, "links"), None
    for _ in range(most_rounds):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if state == before or not state[0]:
            return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before, current = state, fixed(contracted(current), "links")
    raise RuntimeError("components did not settle")
