"""A corpus through quality classifier, quality rules, near and exact deduplication, and packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.llm import packing, passages, quality, rules, setsketch
from isohour.llm.common import fixed, workers_import

WORD_BPE = "word_bpe_49k.json"
#: Words of a shingle in the near-duplicate stage; the query op5 has two.
NEAR_WORDS = 5
#: Words of a passage in the repeated-passages stage; the query op8 counts 400 bytes.
PASSAGE_WORDS = 50
#: Quality classification, near duplicates and whole-text digests have no SQL form; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose id is among ``kept``; a missing id is an id like others."""
    return docs.join(kept.select("doc_id").distinct(), docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be bad."""
    workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return only(docs, quality.classify(docs, labels).where("predicted = 1"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. The verdict stands beside the row, so that texts need no shuffle; a rejected row whose id
    another row is kept under stays."""
    judged = rules.judge(docs, whole=True)
    kept = judged.where("kept")
    return kept.select("row.*").unionByName(only(judged.where("NOT kept").select("row.*"), kept))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by five-word shingles, the one of the smallest id."""
    workers_import(spark)
    return only(docs, setsketch.near_duplicates(docs, width=NEAR_WORDS).where("kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of ``PASSAGE_WORDS`` words that another document holds; n_chars follows the text."""
    workers_import(spark)
    left = passages.without_repeats(docs, length=PASSAGE_WORDS)
    return left.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    workers_import(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = fixed(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
