"""Removal of long strings that occur more than once in the corpus.

A unit (byte or word) goes if a string of ``length`` units that covers it also starts elsewhere: anywhere, or with
``across`` in another document. Suffixes are compared by prefix polynomial hashes: with running sums of the hash, any
substring's hash costs a constant, so equal prefixes are found by hash and common extensions by a search that halves in on
where they end. Sorting suffixes is left to Spark's shuffles, which bring equal prefix hashes together:

1. Anchors. Of the short strings inside every window of ``length`` units the one of the least hash is its
   anchor; equal windows have equal anchors, so windows with an anchor that occurs once are unique.
   Neighbouring windows share anchors, so there are few.
   An anchor whose whole context (all units of its windows) is found again is settled: all its windows repeat.
2. Cells. The windows of any other repeated anchor are looked at in cells of up to ``CELL`` neighbours. What all windows of
   a cell have in common (its core) must be repeated, or none of them is. If the union of the
   cell's windows is repeated, all of them are.
3. Windows. What is still open, at the ends of passages, is compared window by window. Of each kind of
   settled anchors and cells one takes part for all of its kind, or two of two documents where another document is asked for.

Collisions: hashes run over mixed 8-byte values; unions and windows are compared by two independent 64-bit
hashes, and both must agree. A repeated hash counts only if it occurs at two different places.
Counts are aggregated before any shuffle, so passages of any number of copies are two numbers per task.

Defined results: null and empty texts have no units and no spans. Texts shorter than ``length`` stay. A document is a
doc_id with a text: repeated rows of both are one document and get equal result rows, another text under the same
doc_id is another document; rows without doc_id stay as they are. What is kept is decoded again with partial
characters dropped. Extra columns are ignored, or returned as they are by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import Copy, fixed, forget, passing, slices
from isohour.llm.shingles import mixed

CELL = 16
SEGMENT = 1 << 20
BATCH_BYTES = 2 << 20
KEY = ("doc_id", "version")
A_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ANCHOR = ("key", "context", "at", "first", "last")
PLACE_BITS = np.uint64((1 << 24) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        base = _BASES[which]
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            made = np.ones(size, np.uint64)
            made[1:] = np.uint64(b)
            both.append(np.multiply.accumulate(made))
        _powers[which] = both[0], both[1]
    return _powers[which]


class Units:
    """A text as a row of units with one value at each place that depends on ``gram`` of them: bytes eight at a
    time, or words one by one."""

    def __init__(self, raw: bytes, words: bool) -> None:
        if words:
            found = [xxhash.xxh3_64_intdigest(word) for word in A_WORD.findall(raw)]
            self.gram, self.values = 1, np.array(found, np.uint64)
        else:
            n = max(len(raw) - 7, 0)
            self.gram, self.values = 8, np.ndarray((n,), "<u8", raw, strides=(1,)) if n else np.zeros(0, np.uint64)
        self.size = len(self.values) + self.gram - 1

    def prefixes(self, start: int, end: int) -> Prefixes:
        return Prefixes(self.values[start : end - self.gram + 1], self.gram)


class Prefixes:
    """Running polynomial hashes of one stretch of units."""

    def __init__(self, values: np.ndarray, gram: int) -> None:
        self.gram = gram
        values = mixed(values)
        n = len(values)
        self.sums = []
        for which in (0, 1):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(values * powers(which, n)[0][:n], out=total[1:])
            self.sums.append(total)

    def hashes(self, starts: np.ndarray, length: int | np.ndarray, which: int) -> np.ndarray:
        total, inverse = self.sums[which], powers(which, len(self.sums[which]))[1]
        return mixed((total[starts + (length - self.gram + 1)] - total[starts]) * inverse[starts])


def stretches(size: int, length: int) -> Iterator[tuple[int, int]]:
    """Cuts of a text, each with the bytes that windows starting in it reach; long texts take several."""
    for start in range(0, size - length + 1, SEGMENT):
        yield start, min(size, start + SEGMENT + length - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def anchors(units: Units, length: int, short: int) -> tuple[list[np.ndarray], ...]:
    """Hash, context, place, first and last window start of every anchor. The context hashes all bytes of the
    anchor's windows and where in them the anchor lies."""
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    for start, end in stretches(units.size, length):
        n = end - start - short + 1
        prefixes = units.prefixes(start, end)
        hashes = prefixes.hashes(np.arange(n), short, 0)
        least = sliding_least((hashes & ~PLACE_BITS) | np.arange(n, dtype=np.uint64), length - short + 1)
        at = (least & PLACE_BITS).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        context = prefixes.hashes(first, last - first + length, 1)
        context = mixed(context ^ mixed(((at[first] - first) * length + last - first).astype(np.uint64)))
        keys = hashes[at[first]].view(np.int64), context.view(np.int64)
        for column, values in zip(found, (*keys, at[first] + start, first + start, last + start)):
            column.append(values)
    return tuple(found)


def document_anchors(docs: DataFrame, length: int, short: int, words: bool) -> DataFrame:
    """Per document its anchors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", BATCH_BYTES):
            columns = [], [], [], [], []
            for text in batch.column(2):
                for column, parts in zip(columns, anchors(Units(text.as_py().encode(), words), length, short)):
                    column.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
            arrays = [pa.array(c, pa.list_(pa.int64())) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["doc_id", "stamp", *ANCHOR])

    lists = ", ".join(f"{c} array<bigint>" for c in ANCHOR)
    return docs.mapInArrow(rows, f"doc_id bigint, stamp bigint, {lists}")


def at_places(units: Units, starts: np.ndarray, length: int, hashes: int) -> list[np.ndarray]:
    """Hashes of the strings of ``length`` bytes at rising ``starts``, stretch by stretch."""
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(hashes)]
    for start, end in stretches(units.size, length):
        low, high = np.searchsorted(starts, [start, start + SEGMENT])
        if low < high:
            prefixes = units.prefixes(start, end)
            for which in range(hashes):
                found[which].append(prefixes.hashes(starts[low:high] - start, length, which).view(np.int64))
    return [np.concatenate(f) for f in found]


def cells_of(units: Units, spots: list[dict], length: int) -> dict[str, np.ndarray]:
    """Cells of windows around repeated anchors: absolute first window, the part of it that belongs to the anchor,
    the core's hash and, where the union lies inside the text, the union's two hashes."""
    starts, lows, highs = [], [], []
    cell = max(1, min(CELL, length // 4))
    for spot in spots:
        at, first, last = spot["at"], spot["first"], spot["last"]
        begins = np.arange(at - -(-(at - first) // cell) * cell, last + 1, cell)
        starts.append(begins)
        lows.append(np.maximum(begins, first))
        highs.append(np.minimum(begins + cell - 1, last))
    start, low, high = (np.concatenate(x) for x in (starts, lows, highs))
    order = np.argsort(start, kind="stable")
    start, low, high = start[order], low[order], high[order]
    core = at_places(units, start + cell - 1, length - cell + 1, 1)[0]
    inside = (start >= 0) & (start + cell - 1 + length <= units.size)
    union = np.zeros((2, len(start)), np.int64)
    union[:, inside] = at_places(units, start[inside], length + cell - 1, 2)
    return {"start": start, "low": low, "high": high, "core": core, "inside": inside, "u1": union[0], "u2": union[1]}


def cells(texts: DataFrame, length: int, words: bool) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            for key, version, text, spots in zip(*(c.to_pylist() for c in batch.columns)):
                made = cells_of(Units(text.encode(), words), spots, length)
                outside = ~made["inside"]
                union = [pa.array(made[u], mask=outside) for u in ("u1", "u2")]
                plain = [pa.array(made[c]) for c in ("start", "low", "high", "core")]
                doc = [pa.array(np.full(len(outside), k, np.int64)) for k in (key, version)]
                yield pa.RecordBatch.from_arrays([*doc, *plain, *union], [*KEY, "start", "low", "high", "core", "u1", "u2"])

    shape = "doc_id bigint, version bigint, start bigint, low bigint, high bigint, core bigint, u1 bigint, u2 bigint"
    return texts.select(*KEY, "text", "spots").mapInArrow(rows, shape)


def windows(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """Every single window of the open cells."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            for key, version, text, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                start = np.unique(np.concatenate([np.arange(r["low"], r["high"] + 1) for r in ranges]))
                both = at_places(Units(text.encode(), words), start, length, 2)
                doc = [pa.array(np.full(len(start), k, np.int64)) for k in (key, version)]
                yield pa.RecordBatch.from_arrays([*doc, *map(pa.array, (start, *both))], [*KEY, "start", "w1", "w2"])

    return texts.select(*KEY, "text", "ranges").mapInArrow(rows, "doc_id bigint, version bigint, start bigint, w1 bigint, w2 bigint")


def place_of(start: str, across: bool) -> Column:
    """What must differ for a string to count as repeated."""
    return F.xxhash64(*KEY, *([] if across else [start]))


def repeated(rows: DataFrame, across: bool, *hashes: str) -> DataFrame:
    """The hashes found at two different places at least."""
    place = place_of("start", across)
    ends = rows.groupBy(*hashes).agg(F.min(place).alias("one"), F.max(place).alias("other"))
    return ends.where("one <> other").select(*hashes)


def anchors_met(spots: DataFrame, across: bool) -> DataFrame:
    """Anchors found at several places, marked ``whole`` where their whole context is found again, and ``open`` where
    windows must be looked at: all others, and one of each kind of whole ones that others may share windows with. Across
    documents it is those of two documents, as the one may be the document that asks."""
    place = place_of("at", across)
    kinds = spots.groupBy("key", "context").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    kinds = kinds.withColumn("whole", F.col("one") != F.col("other"))
    keys = kinds.groupBy("key").agg(
        F.min("one").alias("first_one"), F.max("other").alias("last_one"), F.count(F.when(~F.col("whole"), 1)).alias("single")
    )
    keys = keys.where("first_one <> last_one").select("key", "single")
    known = kinds.join(keys, "key").select("key", "context", "whole", "single", "one", "other")
    chosen = (place == F.col("one")) | (place == F.col("other")) if across else place == F.col("one")
    met = spots.join(known, ["key", "context"])
    return met.select(*KEY, "at", "first", "last", "whole", (~F.col("whole") | (F.col("single") > 0) & chosen).alias("open"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, joined; ends are exclusive."""
    found: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans):
        if found and low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    return [tuple(f) for f in found]


def byte_spans(raw: bytes, spans: list[tuple[int, int]], words: bool) -> list[tuple[int, int]]:
    """Spans of units as spans of bytes."""
    if not words or not spans:
        return spans
    at = [m.span() for m in A_WORD.finditer(raw)]
    return [(at[low][0], at[high - 1][1]) for low, high in spans]


def without(texts: DataFrame, kept: str, words: bool) -> DataFrame:
    """Every row with its sizes and what is left of its text; the column ``kept`` passes through."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            made = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                gone = byte_spans(raw, merged(spans or []), words)
                edges = [0, *(e for span in gone for e in span), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                made.append((len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
            types = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()
            columns = [pa.array(c, t) for c, t in zip(zip(*made), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [kept, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    shape = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    return texts.mapInArrow(rows, f"{kept} {texts.schema[kept].dataType.simpleString()}, {shape}")


def repeats(rows: DataFrame, length: int, short: int, words: bool, across: bool, held: Copy) -> DataFrame:
    """doc_id, version and spans of the documents that hold repeated strings. ``rows`` are doc_id, stamp (of the text), text.
    The version is the stamp where some doc_id has several texts, and 0 where none has. ``held`` copies what is read again."""
    anchored = held(document_anchors(rows.where("doc_id IS NOT NULL"), length, short, words), "anchors")
    texts_of_id = anchored.groupBy("doc_id").agg(F.min("stamp").alias("one"), F.max("stamp").alias("other"))
    version = F.lit(0).cast("bigint") if texts_of_id.where("one <> other").isEmpty() else F.col("stamp")
    spots = anchored.select("doc_id", version.alias("version"), F.explode(F.arrays_zip(*ANCHOR)).alias("s")).select(*KEY, "s.*")
    span = F.struct(F.col("first").alias("low"), (F.col("last") + length).alias("high"))
    by_doc = anchors_met(spots, across).groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("open"), F.struct("at", "first", "last"))).alias("spots"),
        F.collect_list(F.when(F.col("whole"), span)).alias("spans"),
    )
    by_doc = held(by_doc, "spots")
    texts = rows.withColumn("version", version).select(*KEY, "text")
    open_docs = by_doc.where("size(spots) > 0").select(*KEY, "spots")
    open_texts = held(texts.join(open_docs, [*KEY]), "repeat-texts")

    looked = held(cells(open_texts, length, words), "cells")
    live = looked.join(repeated(looked, across, "core"), "core")
    whole = repeated(live.where("u1 IS NOT NULL"), across, "u1", "u2").withColumn("whole", F.lit(True))
    live = live.join(whole, ["u1", "u2"], "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    live = held(live.select(*KEY, "start", "low", "high", "core", "u1", "u2", "whole"), "live-cells")
    mixed = live.where("NOT whole")
    # A window of an open cell may be repeated inside repeated cells: those of one or two documents of each kind stand for all.
    met = live.where("whole").join(mixed.select("core").distinct(), "core")
    part = F.col("low") - F.col("start"), F.col("high") - F.col("start")  # cells of two anchors may coincide
    one = F.struct(*KEY, "low", "high")
    ends = [F.min(one), F.max(one)] if across else [F.min(one)]
    stand = met.groupBy("core", "u1", "u2", *part).agg(F.array(*ends).alias("ends")).select(F.explode("ends").alias("c")).select("c.*")
    opened = mixed.select(*KEY, "low", "high").unionByName(stand)
    open_cells = opened.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    single = held(windows(open_texts.select(*KEY, "text").join(open_cells, [*KEY]), length, words), "windows")
    twice = single.join(repeated(single, across, "w1", "w2"), ["w1", "w2"])

    late = live.where("whole").select(*KEY, F.col("low"), (F.col("high") + length).alias("high"))
    late = late.unionByName(twice.select(*KEY, F.col("start").alias("low"), (F.col("start") + length).alias("high")))
    late = late.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("late"))
    found = by_doc.select(*KEY, "spans").join(late, [*KEY], "left")
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    spans = F.concat("spans", F.coalesce("late", none))
    return found.select(*KEY, spans.alias("spans")).where("size(spans) > 0")


def cut(docs: DataFrame, kept: Column, length: int, short: int, words: bool, across: bool, key: str, text: str) -> DataFrame:
    """Per row the column ``kept`` as "kept", its sizes and what is left of its text."""
    rows = docs.select(
        kept.alias("kept"), F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("stamp", F.xxhash64("text"))
    with passing(docs.sparkSession) as held:
        spans = fixed(repeats(rows.select("doc_id", "stamp", "text"), length, short, words, across, held), "spans")
    # a document's version is its stamp or 0 for all
    mine = (rows["doc_id"] == spans["doc_id"]) & spans["version"].isin(F.lit(0), rows["stamp"])
    return without(rows.join(spans, mine, "left").select("kept", "text", "spans"), "kept", words)


def deduplicate(docs: DataFrame, length: int = 400, short: int = 100, key: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, with ``texts`` also the remaining text as "text"."""
    made = cut(docs, F.col(key).cast("bigint"), length, short, False, False, key, text)
    names = "n_bytes", "n_removed", "n_spans", "kept_sha256"
    return made.select(F.col("kept").alias("doc_id"), *names, *([F.col("kept_text").alias("text")] if texts else []))


def without_repeats(docs: DataFrame, length: int = 50, short: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without passages of ``length`` words that another document holds too. A null text stays null."""
    names = [c for c in docs.columns if c != text]
    made = cut(docs, F.struct(*names, F.col(text).isNull().alias("_null")), length, short, True, True, key, text)
    left = F.when(~F.col("kept._null"), F.col("kept_text")).alias(text)
    return made.select(*[left if c == text else F.col(f"kept.{c}").alias(c) for c in docs.columns])
