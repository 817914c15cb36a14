"""Order-preserving packing of documents into token sequences by dynamic programming.

Each task tokenises its documents in order and joins their ids, every document closed by ``end_id``, to one
stream. Windows of at most ``size`` tokens are cut at candidate positions: document ends (free),
sentence ends and, where a sentence is longer than a quarter window, positions inside it. The cuts
minimise padding plus penalties:

    cost(j) = penalty(j) + size - at(j) + min over i with at(j) - at(i) <= size of (cost(i) + at(i))

The minimum over a sliding range comes from a monotone queue, so a candidate costs constant time. A
task works through blocks of ``block`` windows and carries the last window over to the next block. What is
left at the end of a task is cut into powers of two, whose sequences need no padding.

Defined results: null and empty texts are one token, ``end_id``. Repeated rows are packed each; a
document longer than a window spans several. An empty task makes no sequence. Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from isohour.llm.common import kept, slices

SENTENCE_END = frozenset(".!?…")
LAST_LATIN = "\u024f"
#: The tokenizer's own cut of a word into pieces.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
REMEMBERED_BYTES = 150 << 20  # what a worker keeps of words and their pieces, at ENTRY bytes each and their own
ENTRY = 140
BATCH_BYTES = 4 << 20
SHAPE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class Words(dict):
    """Ids of words as bytes, worked out when first asked for.

    The tokenizer drops white space and never looks across it, so a text is its words. Words of Latin
    letters and marks, where lower case and composition are plain, go straight to the merges; the
    tokenizer as a whole takes all others, and every text that holds the string of an added token, which
    it finds before it lower-cases.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.held = 0
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_sign = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        ends = [i for token, i in vocabulary.items() if (bare := token.removesuffix("</w>")) and SENTENCE_END.issuperset(bare)]
        self.sentence_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.sentence_end[ends] = True

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if max(text) > LAST_LATIN:
            found = ids_as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            found = b"".join([self.pieces.get(p) or self.piece(p) for p in PIECE.findall(text.lower())])
        self.keep(len(word) + len(found))
        self[word] = found
        return found

    def keep(self, size: int) -> None:
        """Make room for one more entry; when too much is held, all goes."""
        self.held += size + ENTRY
        if self.held > REMEMBERED_BYTES:
            self.clear()
            self.pieces.clear()
            self.held = size + ENTRY

    def piece(self, piece: str) -> bytes:
        signs = piece if piece.isascii() and piece.isprintable() else "".join([self.byte_sign[b] for b in piece.encode()])
        found = ids_as_bytes([token.id for token in self.merges.tokenize(signs)])
        self.keep(len(piece) + len(found))
        self.pieces[piece] = found
        return found

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return ids_as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.encode().split()))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(self.ids(text or ""), "<u4") for text in texts]


def ids_as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def words_of(path: str) -> Words:
    return kept(("packing", path), lambda: Words(path))


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int, sentence: float, inside: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, rising, and the penalty of each."""
    at = np.union1d(doc_ends, sentence_ends)
    step = max(1, size // 4)
    gaps = np.diff(at, prepend=0)
    long = np.flatnonzero(gaps > step)
    extra = [np.arange(at[k] - gaps[k] + step, at[k], step) for k in long]
    all_at = np.union1d(at, np.concatenate([np.zeros(0, np.int64), *extra])).astype(np.int64)
    penalty = np.full(len(all_at), inside)
    penalty[np.isin(all_at, sentence_ends)] = sentence
    penalty[np.isin(all_at, doc_ends)] = 0.0
    return all_at, penalty


def cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Window ends, the last candidate included, of the least total cost."""
    points, costs = [0, *at.tolist()], [0.0, *penalty.tolist()]
    came = [0] * len(points)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # cost + position, position, index; rising
    for j in range(1, len(points)):
        here = points[j]
        while here - queue[0][1] > size:
            queue.popleft()
        best, _, came[j] = queue[0]
        value = best + costs[j] + size  # cost(j) + at(j)
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, here, j))
    ends, j = [], len(points) - 1
    while j:
        ends.append(points[j])
        j = came[j]
    return ends[::-1]


def powers(length: int, size: int) -> list[int]:
    """Lengths that are powers of two, or ``size``, and add up to ``length``."""
    found = [size] * (length // size)
    rest = length % size
    return found + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class Packer:
    """The stream of one task."""

    def __init__(self, sentence_end: np.ndarray, size: int, block: int, first_id: int, sentence: float, inside: float) -> None:
        self.sentence_end, self.size, self.block = sentence_end, size, block
        self.sentence, self.inside = sentence, inside
        self.next_id = first_id
        self.docs: list[tuple[int, int, np.ndarray, int]] = []  # key, start in the document, its ids, all its ids
        self.held = 0

    def add(self, key: int, ids: np.ndarray) -> None:
        self.docs.append((key, 0, ids, len(ids)))
        self.held += len(ids)

    def full(self) -> bool:
        return self.held >= self.block * self.size

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of all finished windows; with ``last`` of everything."""
        if not self.docs:
            return []
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(d[2]) for d in self.docs])
        found = cuts(*candidates(ends, np.flatnonzero(self.sentence_end[ids]) + 1, self.size, self.sentence, self.inside), self.size)
        tail_from = found[-2] if len(found) > 1 else 0
        done = found[:-1]
        if last:
            done = done + (tail_from + np.cumsum(powers(len(ids) - tail_from, self.size))).tolist()
        pieces, rest, k, begin = [], [], 0, 0
        keys, starts, totals = ([d[i] for d in self.docs] for i in (0, 1, 3))
        begins = ends - [len(d[2]) for d in self.docs]
        for end in done:
            while k < len(ends) and begins[k] < end:
                low, high = max(begin, begins[k]), min(end, ends[k])
                part = ids[low:high]
                crc = zlib.crc32(np.ascontiguousarray(part, "<u4"))
                pieces.append((keys[k], starts[k] + int(low - begins[k]), int(high - low), crc, totals[k], self.next_id, int(low - begin)))
                if ends[k] > end:
                    break
                k += 1
            begin = end
            self.next_id += 1
        for d in range(k, len(ends)):
            used = max(0, begin - int(begins[d]))
            if len(self.docs[d][2]) > used:
                rest.append((keys[d], starts[d] + used, self.docs[d][2][used:], totals[d]))
        self.docs, self.held = rest, sum(len(d[2]) for d in rest)
        return pieces


def pack(
    docs: DataFrame, path: str, size: int = 4096, end_id: int = 2, block: int = 128, sentence: float = 4.0, inside: float = 64.0
) -> DataFrame:
    """One row per piece of a document in a sequence."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        context = TaskContext.get()
        packer = Packer(words.sentence_end, size, block, (context.partitionId() if context else 0) << 40, sentence, inside)
        names = [part.split()[0] for part in SHAPE.split(", ")]

        def made(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces)], names)

        for batch in slices(batches, "text", BATCH_BYTES):
            ids = words.encode(batch.column(1).to_pylist())
            for key, own in zip(batch.column(0).to_pylist(), ids):
                packer.add(key, np.append(own, np.uint32(end_id)))
                if packer.full() and (pieces := packer.flush(last=False)):
                    yield made(pieces)
        if pieces := packer.flush(last=True):
            yield made(pieces)

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return kept.mapInArrow(rows, SHAPE)
