"""Passages of benchmark items in documents, found by an Aho-Corasick automaton over words.

Texts fall into words of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. Each ``width`` consecutive words of an
item are a window; an item of fewer words, but not none, is one window. The windows of all items form one
automaton whose symbols are words: a document is scanned once, however many items there are, and every window that
ends at a word is reported there. Words that no item has are one symbol that leads back to the root.

The automaton lies in every worker, so its size is bounded: (window, item) pairs are dealt by hash into blocks of
about ``block`` pairs, which is what the driver and a broadcast hold at a time. Up to that size there is one
block and one scan, with no shuffle of documents. Beyond it documents are scanned once a block, numbered in a copy, and the hits
of all blocks are put together; results are the same.

Hit words are merged to runs, and runs are mapped back to offsets in the original text (code points, end exclusive).

Defined results: null texts have no words; items without words have no windows, and an item without an id is found under the
empty id. Rows of one item_id are one item, repeated documents are scanned each. Without items nothing is hit.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from isohour.llm.common import fixed, slices

BLOCK = 100_000  # (window, item) pairs of one automaton
BATCH_BYTES = 4 << 20
#: Bytes of words as they are, A-Z in lower case, and all others as spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
A_WORD = re.compile(rb"[^ ]+")
RUN = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("first", "last", "start", "end")]))
SHAPE = f"row bigint, doc_id bigint, n_words bigint, runs {RUN}, items array<string>"


def windows(benchmark: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """Distinct (window, item_id), a window as its words joined by spaces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            for item, raw in zip(*(c.to_pylist() for c in batch.columns)):
                words = raw.encode().translate(WORD_BYTES).split()
                size = min(width, len(words))
                found = {b" ".join(words[k : k + size]).decode() for k in range(len(words) - size + 1)} if words else ()
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([item] * len(found), pa.string())], ["window", "item_id"])

    blank = F.lit("")
    plain = benchmark.select(F.coalesce(F.col(key).cast("string"), blank).alias("item_id"), F.coalesce(F.col(text), blank).alias("text"))
    return plain.mapInArrow(rows, "window string, item_id string").distinct()


class Automaton:
    """Words as numbers, and the windows over them."""

    def __init__(self, pairs: Iterable[tuple[str, str]]) -> None:
        items: dict[str, list[str]] = {}
        for window, item in pairs:
            items.setdefault(window, []).append(item)
        self.numbers = Numbers()
        self.items = list(items.values())
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for at, window in enumerate(items):
            symbols = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.encode().split())
            self.found.add_word(symbols, (len(symbols), at))
        self.found.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Runs of hit words, first and last, and the items of the windows found."""
        if not self.items:
            return [], []
        runs: list[tuple[int, int]] = []
        met = set()
        for last, (size, at) in self.found.iter(tuple(map(self.numbers.__getitem__, words))):
            met.add(at)
            runs.append((last - size + 1, last))
        return joined(runs), sorted({item for at in met for item in self.items[at]})


class Numbers(dict):
    """The number of a word; 0 is any word of no item."""

    def __missing__(self, word: bytes) -> int:
        return 0


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that overlap or follow each other as one."""
    made: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if made and first <= made[-1][1] + 1:
            made[-1] = made[-1][0], max(made[-1][1], last)
        else:
            made.append((first, last))
    return made


def placed(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs of words with their offsets in code points; ``raw`` has its word bytes apart from the others."""
    spans = [(m.start(), m.end()) for m in A_WORD.finditer(raw)]
    before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(first, last, int(before[spans[first][0]]), int(before[spans[last][1]])) for first, last in runs]


_automata: dict[str, Automaton] = {}


def automaton(name: str, pairs: Broadcast) -> Automaton:
    """The worker's automaton of one block; that of another block before makes room."""
    if name not in _automata:
        _automata.clear()
        _automata[name] = Automaton(pairs.value)
    return _automata[name]


def scan(rows: DataFrame, pairs: list[tuple[str, str]], every: bool) -> DataFrame:
    """Hits of one block's windows, for ``every`` row or for those with hits."""
    name, shared = uuid4().hex, rows.sparkSession.sparkContext.broadcast(pairs)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = automaton(name, shared)
        for batch in slices(batches, "text", BATCH_BYTES):
            made = []
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode().translate(WORD_BYTES)
                words = raw.split()
                runs, items = search.hits(words)
                if runs or every:
                    made.append((row, doc, len(words), placed(raw, runs) if runs else [], items))
            if made:
                types = pa.int64(), pa.int64(), pa.int64(), RUNS, pa.list_(pa.string())
                named = [[dict(zip(("first", "last", "start", "end"), r)) for r in m[3]] for m in made]
                columns = [*zip(*made)]
                columns[3] = named
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)], ["row", "doc_id", "n_words", "runs", "items"]
                )

    return rows.mapInArrow(scanned, SHAPE)


def together(hits: DataFrame) -> DataFrame:
    """The runs and items that several blocks found in a row."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row, runs in zip(*(c.to_pylist() for c in batch.select(["row", "runs"]).columns)):
                starts, ends = {r["first"]: r["start"] for r in runs}, {r["last"]: r["end"] for r in runs}
                found = joined([(r["first"], r["last"]) for r in runs])
                made.append([{"first": a, "last": b, "start": starts[a], "end": ends[b]} for a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, RUNS), batch.column(2)], ["row", "runs", "items"])

    per_row = hits.groupBy("row").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    return per_row.mapInArrow(merged, f"row bigint, runs {RUN}, items array<string>")


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, spans of the original text and sorted items of every row."""
    known = fixed(windows(benchmark, width, item, item_text), "windows")
    blocks = max(1, -(-known.count() // block))
    dealt = known.withColumn("block", F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)))
    plain = docs.select(
        F.lit(0).cast("bigint").alias("row"), F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    if blocks > 1:
        plain = fixed(plain.withColumn("row", F.monotonically_increasing_id()), "numbered")

    def hits(k: int) -> DataFrame:
        """About ``block`` pairs reach the driver."""
        pairs = [(r.window, r.item_id) for r in dealt.where(F.col("block") == k).collect()]
        return scan(plain, pairs, k == 0)

    found = hits(0)
    if blocks > 1:
        found = fixed(found, "hits-0")
        parts = found.where("size(runs) > 0").select("row", "runs", "items")
        for k in range(1, blocks):
            parts = parts.unionByName(fixed(hits(k), f"hits-{k}").select("row", "runs", "items"))
        found = found.select("row", "doc_id", "n_words").join(together(parts), "row", "left")
    runs = F.coalesce("runs", F.array().cast(RUN))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1).alias("n_hit"),
        F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def digests(found: DataFrame) -> DataFrame:
    """Rows of ``find`` with counts and a digest in place of the items."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
