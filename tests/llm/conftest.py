from __future__ import annotations

import pytest

from isohour.llm.common import workers_import

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    workers_import(spark)
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark, docs):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash."""
    prose = " ".join(f"word{i}" for i in range(120))
    texts = [None, "", " \n\t", "one", prose, prose, prose + " tail", "x" * 3000, "é" * 50 + " # " * 40, "long " * 20_000]
    rows = [(i, t, "en", "s", 7, 1.5, "w") for i, t in enumerate(texts)] + [(4, prose, None, None, None, None, None), (None, "no id", "en", "s", 1, 1.0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label double, words string")
