"""The SQL twins on tables with links, copies and empty rows; tests/test_catalogue.py runs them over the driver tables."""

from __future__ import annotations

import duckdb
import numpy as np
import oracle
import pytest

from isohour.llm import passages, setsketch, twins, vectors


def test_linked_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(5, 8))
    values = [(base[i % 5] + rng.normal(scale=0.1 * (i % 3), size=8)).astype(np.float32).tolist() for i in range(120)]
    rows = [(i, v, i % 5 % 2) for i, v in enumerate(values)]
    rows += [(120, None, 0), (121, [0.0] * 8, 0), (122, [float("nan")] * 8, 0), (123, [None] * 8, 1), (124, values[0], None), (125, values[0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = vectors.near_duplicates(table)
    con = duckdb.connect()
    con.register("embeddings", table.toArrow())
    assert oracle.compare(found, con, twins.NEAR_VECTORS) == 126
    assert found.where("n_links > 0").count() > 50


@pytest.mark.parametrize("operator, sql", [(setsketch.near_duplicates, twins.NEAR_DUPLICATES), (lambda docs: passages.deduplicate(docs, texts=True), twins.REPEATED_PASSAGES)])
def test_odd_documents(spark, odd, operator, sql):
    table = odd.where("doc_id IS NOT NULL AND label IS NOT NULL")
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    assert oracle.compare(operator(table), con, sql) == table.count()
