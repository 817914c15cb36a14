"""The operators as registered queries over the driver tables, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from isohour.llm import aligning, bpe, leaks, middles, packing, pages, passages, quality, quotes, rules, setsketch, twins, urls, vectors
from isohour.llm.common import workers_import
from isohour.plans.catalogue.registry import Register

register = Register()
BYTE_BPE, WORD_BPE = "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@register()
def op1_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link(table(spark, folder, "conversations"))


@register()
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    return bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@register()
def op3_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"))


@register()
def op4_order_preserving_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


@register(twins.NEAR_DUPLICATES)
def op5_setsketch_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents"))


@register(twins.NEAR_VECTORS)
def op6_embedding_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@register()
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@register(twins.REPEATED_PASSAGES)
def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.deduplicate(table(spark, folder, "documents"), texts=True)


@register()
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register()
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.parse_rules(*URL_RULES))


@register(twins.LEAKS)
def op11_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.digests(leaks.find(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@register()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligning.align(table(spark, folder, "documents"), *map(public_tokenizers.path, ALIGNED))


@register(twins.MIDDLES)
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middles.digests(middles.transform(table(spark, folder, "documents")))


@register(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = register.found
