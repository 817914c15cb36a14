"""URL filter: path rules first, then gradient-boosted trees on lexical features.

Rules of the form ``host suffix/path prefix`` decide the addresses they fit; the longest wins. The
addresses that a rule decides are the labelled ones: the trees are trained on them and judge the
rest. Features: lengths, depth, digit ratio, entropy, parameters, and smoothed block rates of host
suffixes among labelled addresses. A labelled address takes the rates of the other folds only (folds are
cut by the address), so that no label is part of its own features.

Defined results: a null address, or one without ``://``, has an empty host and path. Without
labelled addresses of both verdicts there is nothing to learn and the only verdict seen (allow if
none) is given. Repeated rows each get a verdict; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import fixed

ALLOW, BLOCK = "allow", "block"
FOLDS = 5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def parse_rules(*lines: str) -> list[Rule]:
    """Rules from texts like ``block example.org/es/``."""
    made = []
    for line in lines:
        verdict, where = line.split(" ", 1)
        host, slash, path = where.partition("/")
        made.append(Rule(host.lower(), slash + path, verdict))
    return made


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or NULL."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def suffixes(host: Column) -> dict[str, Column]:
    """The last one, two and three labels of a host."""
    return {f"suffix_{n}": F.substring_index(host, ".", -n) for n in (1, 2, 3)}


def entropy(text: Column) -> Column:
    size = F.length(text)

    def part(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return total - share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: F.length(c) > 0)
    return F.aggregate(chars, F.lit(0.0), part)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "url_chars": F.length(url).cast("double"),
        "host_chars": F.length(host).cast("double"),
        "path_chars": F.length(path).cast("double"),
        "host_labels": F.size(F.split(host, r"\.")).cast("double"),
        "depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "digit_ratio": digits / size,
        "hyphens": (F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
        "entropy": entropy(url),
        "host_entropy": entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "fragment": url.contains("#").cast("double"),
        "secure": url.startswith("https://").cast("double"),
    }


def with_rates(found: DataFrame, name: str) -> DataFrame:
    """The block rate of a suffix as ``{name}_rate``: of all labelled rows for rows without a label, of the labelled rows of the other
    folds for those with one. Sums are per suffix and fold, a bounded number of rows a suffix."""
    per_fold = found.where("label IS NOT NULL").groupBy(name, "fold").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    folds = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("bad", "n").alias("own"))))
    sums = per_fold.groupBy(name).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), folds.alias("folds"))
    own = F.when(F.col("label").isNotNull(), F.col("folds")[F.col("fold")])
    bad = F.coalesce(F.col("bad"), F.lit(0)) - F.coalesce(own["bad"], F.lit(0))
    n = F.coalesce(F.col("n"), F.lit(0)) - F.coalesce(own["n"], F.lit(0))
    return found.join(sums, name, "left").withColumn(f"{name}_rate", (bad + 1) / (n + 2)).drop("bad", "n", "folds")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    key: str = "page_id",
    url: str = "url",
    train_rows: int = 20_000,
    trees: int = 10,
    depth: int = 4,
    seed: int = 1,
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict and the trees' block probability.

    ``train_rows`` bounds the labelled addresses that are fitted, those of the smallest hash;
    suffix statistics cover every labelled address.
    """
    spark = pages.sparkSession
    found = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    found = found.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = found.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    found = fixed(found.withColumns(suffixes(F.col("host"))), "urls")

    features = list(lexical(F.lit(""), F.lit(""), F.lit("")))
    scored = found.withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
    fold = F.pmod(F.crc32(F.coalesce(F.col("url"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")
    scored = scored.withColumns({"label": (F.col("fit.verdict") == BLOCK).cast("double"), "fold": fold})
    for name in suffixes(F.lit("")):
        scored = with_rates(scored, name)
        features.append(f"{name}_rate")

    by_hash = F.xxhash64("url"), F.col("page_id")
    sample = fixed(scored.where("label IS NOT NULL").orderBy(*by_hash).limit(train_rows).select(*features, "label"), "url-sample")
    seen = {r.label for r in sample.select("label").distinct().collect()}
    if len(seen) < 2:
        chance = F.lit(max(seen, default=0.0))
    else:
        assembler = VectorAssembler(inputCols=features, outputCol="features")
        trees_of = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
        model = trees_of.fit(assembler.transform(sample.coalesce(4)))
        scored = model.transform(assembler.transform(scored))
        chance = vector_to_array(F.col("probability"))[1]
    learned = F.when(chance >= 0.5, BLOCK).otherwise(ALLOW)
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), learned).alias("verdict"),
        chance.alias("block_probability"),
    )
