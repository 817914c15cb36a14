"""Quality rules as weak supervision: rules vote, expectation-maximisation weighs the votes.

Each rule looks at counts over the whole text and votes good (1), bad (-1) or abstains (0). Votes
are reduced to counts per vote pattern: at most 3 to the number of rules, whatever the input. Two classes
explain the patterns: a rule that votes says good of a good document, and bad of a bad one, with two
probabilities of its own, its accuracies; whether it votes says nothing. Expectation-maximisation climbs to the most
probable accuracies under Beta priors, and a document is kept if its posterior probability of being good is
at least one half. One bad vote of a rule that finds little is outvoted. Hard limits (``base_failed``) come
first. All of it is DataFrame functions.

Defined results: null and empty texts have no words and fail the base. Repeated rows are judged each,
ties of the posterior keep. Extra columns are ignored. Without documents the priors stand.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import WORD, fixed

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = string.punctuation
WINDOW = 5


def without(text: Column, chars: str) -> Column:
    """The text's length without some characters."""
    return F.length(F.translate(text, chars, ""))


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Counts over the whole text of every row; with ``whole`` also the row itself as "row"."""
    t = F.coalesce(F.col("text"), F.lit(""))
    row = ["row"] if whole else []
    given = [F.struct(*map(F.col, docs.columns)).alias("row")] if whole else []
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *given).select("doc_id", t.alias("text"), *row)
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})"), 1))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))
    n = F.size("words")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.length("text") - without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("text") - without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        (F.length("text") - without(F.col("text"), MARKS)).cast("long").alias("n_marks"),
        F.transform(lines, lambda line: F.xxhash64(line)).alias("lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        *row,
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_marks", "n_distinct_words",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(rows).alias("n_repeat_words"),
        *row,
    )


def repeated_words(rows: DataFrame) -> Column:
    """Words inside windows whose hash is found twice or more in the text.

    Windows are sorted by hash, those equal to a neighbour are kept and put back in text order; each
    covers the words up to the next such window, five at most.
    """
    nothing = F.array().cast("array<int>")

    def starts(pairs: Column) -> Column:
        def repeated(x: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(pairs, j - 1)["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(pairs, j + 1)["h"] == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(pairs, repeated), lambda x: x["i"]))

    def covered(found: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            gap = F.when(total["last"].isNull(), WINDOW).otherwise(F.least(i - total["last"], F.lit(WINDOW)))
            return F.struct((total["n"] + gap).cast("int").alias("n"), i.alias("last"))

        zero = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("last"))
        return F.aggregate(found, zero, add)["n"]

    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Binding through one-element arrays evaluates the sorted windows and the starts once.
    bound = F.transform(F.array(pairs), lambda p: starts(p))
    total = F.transform(bound, lambda s: covered(s))[0]
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return F.when(repeats, total).otherwise(F.size(nothing)).cast("long")


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """A vote of every rule, from the columns of ``counts``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    size = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    upper = F.col("n_upper") / chars
    marks = F.col("n_marks") / chars
    repeats = F.col("n_repeat_words") / words
    copies = F.col("n_dup_lines") / lines
    variety = F.col("n_distinct_words") / words
    return {
        "word_length": vote(size.between(3, 12), (size < 2) | (size > 16)),
        "symbols": vote(symbols < 0.02, symbols > 0.2),
        "marks": vote(marks < 0.06, marks > 0.08),
        "capitals": vote(upper < 0.2, upper > 0.5),
        "repeats": vote(repeats < 0.1, repeats > 0.16),
        "copied_lines": vote(copies < 0.2, copies > 0.4),
        "length": vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "variety": vote(variety > 0.3, variety < 0.1),
    }


#: Prior beliefs: the share of good documents, and how often a voting rule is right on good and on bad ones (most rules
#: find nothing wrong with most bad documents). They
#: count as much as this share of the documents, so that the result does not depend on how many there are.
GOOD, RIGHT_ON_GOOD, RIGHT_ON_BAD = 0.9, 0.97, 0.25
BELIEF = 0.02


@dataclass
class Weights:
    """The share of good documents and, per rule, how often its votes are right on good and on bad ones."""

    good: float
    right: dict[str, tuple[float, float]]

    def added(self, rule: str) -> tuple[float, float]:
        """Log odds of good that a good and a bad vote add."""
        on_good, on_bad = self.right[rule]
        return math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for rule in self.right:
            for_good, for_bad = self.added(rule)
            total = total + F.when(F.col(rule) == 1, for_good).when(F.col(rule) == -1, for_bad).otherwise(0.0)
        return total

    def both(self, pattern: dict[str, int]) -> tuple[float, float]:
        """Log chance of a good and of a bad document with these votes, given which rules vote."""
        good, bad = math.log(self.good), math.log(1 - self.good)
        for rule, said in pattern.items():
            on_good, on_bad = self.right[rule]
            if said:
                good += math.log(on_good if said == 1 else 1 - on_good)
                bad += math.log(on_bad if said == -1 else 1 - on_bad)
        return good, bad


def most_probable(hits: float, all_: float, mean: float, strength: float) -> float:
    """The peak of a Beta posterior whose prior has its peak at ``mean``."""
    return (hits + mean * strength) / (all_ + strength)


def estimate(
    patterns: list[tuple[tuple[int, ...], int]], rules: list[str], rounds: int = 200, belief: float = BELIEF
) -> tuple[Weights, list[float]]:
    """Expectation-maximisation over vote patterns and how often each occurs, from the priors' peaks on.

    Also returns the log posterior before each round, which never falls; rounds end when it stands still.
    """
    said = [(dict(zip(rules, pattern)), n) for pattern, n in patterns]
    total = sum(n for _, n in patterns)
    strength = max(1.0, belief * total)
    weights = Weights(GOOD, {r: (RIGHT_ON_GOOD, RIGHT_ON_BAD) for r in rules})
    trace: list[float] = []
    for _ in range(rounds):
        shares, level = [], strength * (GOOD * math.log(weights.good) + (1 - GOOD) * math.log(1 - weights.good))
        for on_good, on_bad in weights.right.values():
            level += strength * (RIGHT_ON_GOOD * math.log(on_good) + (1 - RIGHT_ON_GOOD) * math.log(1 - on_good))
            level += strength * (RIGHT_ON_BAD * math.log(on_bad) + (1 - RIGHT_ON_BAD) * math.log(1 - on_bad))
        for pattern, n in said:
            good, bad = weights.both(pattern)
            top = max(good, bad)
            either = top + math.log(math.exp(good - top) + math.exp(bad - top))
            level += n * either
            shares.append((n * math.exp(good - either), n * math.exp(bad - either)))
        trace.append(level)
        if len(trace) > 1 and level - trace[-2] <= 1e-10 * abs(level):
            break
        weights = Weights(most_probable(sum(g for g, _ in shares), total, GOOD, strength), {})
        for rule in rules:
            sums = {(y, v): sum(s[y] for s, (pattern, _) in zip(shares, said) if pattern[rule] == v) for y in (0, 1) for v in (-1, 1)}
            weights.right[rule] = (
                most_probable(sums[0, 1], sums[0, 1] + sums[0, -1], RIGHT_ON_GOOD, strength),
                most_probable(sums[1, -1], sums[1, 1] + sums[1, -1], RIGHT_ON_BAD, strength),
            )
    return weights, trace


def judge(docs: DataFrame, least_words: int = 10, repeat_percent: int = 20, whole: bool = False) -> DataFrame:
    """Counts, base_failed, posterior and kept for every row; with ``whole`` also the row itself as "row"."""
    voted = fixed(counts(docs, whole=whole).withColumns(votes()), "votes")
    rules = list(votes())
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    table = voted.where(~base).groupBy(*rules).count().collect()  # bounded by the number of patterns
    weights, _ = estimate(sorted((tuple(row[r] for r in rules), row["count"]) for row in table), rules)
    posterior = 1 / (1 + F.exp(-weights.log_odds()))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~base & (posterior >= 0.5)).alias("kept"),
        posterior.alias("posterior"),
        *(["row"] if whole else []),
    )
