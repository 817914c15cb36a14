"""Fill-in-the-middle: a text becomes prefix, suffix and middle, cut at line borders.

Where to cut needs each text's number of lines and the place of two of them. A rolling hash over ``WINDOW``
bytes cuts texts into chunks at places that the content chooses, so that copied passages give the same chunks
wherever they lie. A worker keeps a boundary summary of each chunk by its whole content (line ends, characters),
which verifies every hit: equal bytes, not equal hashes. Running sums of the chunks' counts find the chunk of a
cut, and its summary the place inside. Summaries of any cut add up, so a text's result does not depend on
where it was chunked or on what a worker kept.

Lines are ``[^\\n]*\\n|[^\\n]+``. Numbers drawn from sha256 of ``seed:doc_id`` choose cuts and form.

Defined results: null and empty texts are plain, with no lines and an empty output; so are texts that hold one of
the marks. A null doc_id draws its numbers as an empty id. Repeated rows are transformed each, alike. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import slices
from isohour.llm.shingles import mixed

MARKS = ("<P>", "<S>", "<M>")
WINDOW = 32  # bytes that decide on a chunk's end: a 32-bit hash shifts older ones out
CHUNK_BITS = 10  # one place in 1,024 ends a chunk
LONGEST = 1 << 16  # bytes of a chunk where content chooses no end
REMEMBERED_BYTES = 64 << 20  # bytes of chunks that a worker keeps summaries of
BATCH_BYTES = 4 << 20
NEWLINE = 10
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def chunk_ends(raw: np.ndarray) -> np.ndarray:
    """Places after which the last ``WINDOW`` bytes end a chunk."""
    rolling = GEAR[raw]
    reach = 1
    while reach < WINDOW:
        rolling[reach:] = rolling[reach:] + (rolling[:-reach] << np.uint32(reach))
        reach *= 2
    return np.flatnonzero(rolling >> np.uint32(32 - CHUNK_BITS) == 0) + 1


def chunks_of(joined: bytes, sizes: list[int]) -> Iterator[list[bytes]]:
    """The chunks of each of several texts that lie one after the other; none spans two texts, and no window
    that reaches into the text before counts."""
    ends = chunk_ends(np.frombuffer(joined, np.uint8))
    start = 0
    for size in sizes:
        low, high = np.searchsorted(ends, [start + WINDOW, start + size])
        edges = [start, *ends[low:high].tolist(), start + size]
        yield [
            joined[at : min(at + LONGEST, after)]
            for before, after in zip(edges, edges[1:])
            for at in range(before, after, LONGEST)
        ]
        start += size


def characters(raw: bytes) -> int:
    """Code points that start in these bytes."""
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


class Summaries(dict):
    """Line ends and characters by a chunk's content, worked out when first asked for."""

    held = 0

    def __missing__(self, chunk: bytes) -> tuple[np.ndarray, int]:
        self.held += len(chunk)
        if self.held > REMEMBERED_BYTES:
            self.clear()
            self.held = len(chunk)
        line_ends = np.flatnonzero(np.frombuffer(chunk, np.uint8) == NEWLINE) + 1
        found = self[chunk] = line_ends, characters(chunk)
        return found


class Lines:
    """A text's line borders from the summaries of its chunks."""

    def __init__(self, chunks: list[bytes], summaries: Summaries) -> None:
        self.chunks = chunks
        self.found = [summaries[chunk] for chunk in chunks]
        self.lines = list(accumulate((len(ends) for ends, _ in self.found), initial=0))
        self.open = bool(chunks) and chunks[-1][-1] != NEWLINE
        self.count = self.lines[-1] + self.open

    def after(self, k: int) -> tuple[int, int]:
        """Bytes and characters of the first ``k`` lines."""
        if k == 0:
            return 0, 0
        if k > self.lines[-1]:
            return sum(map(len, self.chunks)), sum(n for _, n in self.found)
        at = int(np.searchsorted(self.lines, k)) - 1
        inside = int(self.found[at][0][k - self.lines[at] - 1])
        before = sum(map(len, self.chunks[:at])), sum(n for _, n in self.found[:at])
        return before[0] + inside, before[1] + characters(self.chunks[at][:inside])


def drawn(seed: int, key: int | None) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def arranged(raw: bytes, lines: Lines, numbers: list[int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, characters of prefix and middle, and the output of one text."""
    n = lines.count
    if not raw or numbers[2] % 100 >= rate or any(mark.encode() in raw for mark in MARKS):
        return n, "plain", None, None, raw
    (low, low_chars), (high, high_chars) = map(lines.after, sorted(h % (n + 1) for h in numbers[:2]))
    prefix, middle, suffix = raw[:low], raw[low:high], raw[high:]
    form = "spm" if numbers[3] % 100 < spm else "psm"
    parts = (b"<S>", suffix, b"<P>", prefix) if form == "spm" else (b"<P>", prefix, b"<S>", suffix)
    return n, form, low_chars, high_chars - low_chars, b"".join([*parts, b"<M>", middle])


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row; ``rate`` per cent are transformed,
    ``spm`` per cent of those with the suffix first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            cut = chunks_of(b"".join(texts), list(map(len, texts)))
            made = [
                arranged(raw, Lines(chunks, summaries), drawn(seed, k), rate, spm)
                for k, raw, chunks in zip(batch.column(0).to_pylist(), texts, cut)
            ]
            types = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()
            columns = [pa.array(c, t) for c, t in zip(zip(*made), types)]
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns[:-1], columns[-1].cast(pa.string())], names)

    plain = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shape = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return plain.mapInArrow(rows, shape)


def restored(output: Column, form: Column) -> Column:
    """The exact text again. The marks cannot occur in the parts, so the first of each is the mark."""
    p, s, m = (F.instr(output, mark) for mark in MARKS)

    def between(low: Column, high: Column) -> Column:
        return F.substring(output, low + 3, high - low - 3)

    middle = F.substring(output, m + 3, F.length(output))
    return (
        F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(form == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )


def digests(made: DataFrame) -> DataFrame:
    """Transformed rows with digests in place of the output."""
    output = F.col("output")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(output, F.col("form")), 256).alias("restored_sha256"),
    )
