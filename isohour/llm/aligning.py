"""Alignment of two tokenizers' tokens over the same text, and how often corpus-wide two ids meet.

A is a byte-level BPE over space + text, B a piece model that adds the space itself. Both cut the same bytes, so
each side is its array of token ends, and both arrays end a group wherever they hold the same offset.

Diagonal run skipping: while tokens correspond one to one, the ends are equal at one index shift. Exponential
probing compares stretches of 1, 2, 4, ... ends at the current shift, halves back to the first difference and jumps
the whole stretch. The irregular group behind it is resolved by stepping the side that lags until both meet, and
the shift becomes what it is there. A step is also a link: one pair of tokens that overlap.

Counts: documents of about ``BLOCK_BYTES`` form a block, whose distinct id pairs are a short list next to its documents'
indexes into it. Blocks' document counts add up to the corpus-wide ones by id pair; those come back to each block's
list by a join, and documents are summed block by block. What is shuffled grows with the distinct pairs of blocks,
not with tokens, and a frequent pair has one row a block.

Words are encoded and aligned once per worker (a bounded number is kept) where neither tokenizer looks across the blanks between them; texts
with other white space or control characters are encoded whole. Tokens of both sides end with every word that they spell, so the
groups and links of a text are those of its words in order. The new words of a block are aligned as one text.

Defined results: null and empty texts, and texts whose tokens do not give the bytes of space + text back, have no
tokens: zeros and an empty digest. Repeated rows are documents of their own and count each. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from isohour.llm.common import fixed, slices

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
REMEMBERED_BYTES = 160 << 20  # what a worker keeps, at ENTRY bytes a word and its own
PIECE_BYTES = 96 << 20  # the same for pieces of words
ENTRY = 360
SEGMENT = 20_000  # words that are aligned, or put together, at a time
END = (1 << 62, 0, 0, 0)
NEAR = 8
B_BITS = 16  # an id pair as one number: A's id above B's
#: Blanks and marks that tokenizers may treat unlike a plain space.
UNUSUAL = re.compile(r"[\x00-\x09\x0b-\x1f\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff\ufff0-\uffff]")
#: A space and what follows up to the next space behind a word; blanks at the end of a text stay with the last word.
LAST_LATIN = "\u024f"
#: The byte-level tokenizer's own cut of a text into pieces.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
WORD = re.compile(r" [ \n]*(?:[^ \n]+\n[ \n]*)*[^ \n]*(?:[ \n]+\Z)?")


class Side:
    """One tokenizer: ids of strings, and each id's bytes."""

    def __init__(self) -> None:
        self.token_bytes: list[bytes] = self.bytes_of_ids()
        self.sizes = np.array(list(map(len, self.token_bytes)), np.int64)

    def bytes_of_ids(self) -> list[bytes]:
        raise NotImplementedError

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space."""
        raise NotImplementedError

    def parts(self, texts: list[str]) -> Iterator[tuple[bytes, bytes | None]]:
        """Ids of each text as int32 bytes, and its tokens' bytes where those are not the text's."""
        token_bytes = self.token_bytes
        for text, ids in zip(texts, self.ids(texts)):
            given = b"".join([token_bytes[i] for i in ids])
            yield array("i", ids).tobytes(), None if given == text.encode() else given


class ByteLevel(Side):
    """A byte-level BPE file; strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model
        self.pieces: dict[str, list[int]] = {}
        self.held = 0
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.signs = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        super().__init__()

    def bytes_of_ids(self) -> list[bytes]:
        byte_of = {sign: b for b, sign in self.signs.items()}
        made = [b""] * self.tokenizer.get_vocab_size()
        for token, i in json.loads(self.tokenizer.to_str())["model"]["vocab"].items():
            made[i] = bytes(byte_of[sign] for sign in token)
        return made

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.tokenizer.encode(t, add_special_tokens=False).ids if max(t) > LAST_LATIN else self.merged(t) for t in texts]

    def merged(self, text: str) -> list[int]:
        """The merges alone, for letters whose classes are settled; pieces are remembered."""
        if PLAIN.fullmatch(text):
            return self.piece(text)
        found: list[int] = []
        for piece in PIECE.findall(text):
            found += self.pieces.get(piece) or self.remembered(piece)
        return found

    def remembered(self, piece: str) -> list[int]:
        self.held += len(piece) + ENTRY
        if self.held > PIECE_BYTES:
            self.pieces.clear()
            self.held = len(piece) + ENTRY
        found = self.pieces[piece] = self.piece(piece)
        return found

    def piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():
            signs = piece.replace(" ", self.signs[32])
        else:
            signs = "".join([self.signs[b] for b in piece.encode()])
        return [token.id for token in self.merges.tokenize(signs)]


class Pieces(Side):
    """A piece model that puts one space in front of a text."""

    def __init__(self, path: str) -> None:
        self.model = SentencePieceProcessor(model_file=path)
        super().__init__()

    def bytes_of_ids(self) -> list[bytes]:
        made = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            made.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        return made

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


_sides: dict[tuple[type, str], Side] = {}


def side(kind: type[Side], path: str) -> Side:
    """The worker's own copy; the file is read once per worker."""
    if (kind, path) not in _sides:
        _sides[kind, path] = kind(path)
    return _sides[kind, path]


def words_of(text: str) -> list[str]:
    """A text that begins with a space, cut before spaces that follow a word; whole where it holds unusual blanks."""
    return [text] if UNUSUAL.search(text) else WORD.findall(text)


def one_to_one(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends from ``i`` and ``j`` on are equal one by one."""
    most = min(len(a) - i, len(b) - j)
    done, reach = 0, 1
    while done < most:
        left, right = a[i + done : i + done + reach], b[j + done : j + done + reach]
        if left != right:
            while reach > 1:
                reach //= 2
                if left[:reach] == right[:reach]:
                    done += reach
                    left, right = left[reach:], right[reach:]
            return done
        done += len(left)
        reach *= 2
    return done


def diagonals(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]], list[int], list[int]]:
    """Stretches (i, j, length) of one-to-one tokens, irregular groups (i, j, first behind in a, in b), and the links inside
    those. Both arrays rise to the same last end. Most stretches are short, so the first ``NEAR`` ends are compared one by one
    and probing starts behind them."""
    stretches, groups, left, right = [], [], [], []
    n = len(a)
    a, b = [*a, -1], [*b, -2]
    i = j = 0
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            k, m, near = i, j, i + NEAR
            while x == y:
                k += 1
                m += 1
                if k == near:
                    length = one_to_one(a, b, k, m)
                    k += length
                    m += length
                    x, y = a[k], b[m]
                    break
                x, y = a[k], b[m]
            stretches.append((i, j, k - i))
            i, j = k, m
            if i >= n:
                break
        k, m = i, j
        while x != y:
            left.append(k)
            right.append(m)
            if x < y:
                k += 1
                x = a[k]
            else:
                m += 1
                y = b[m]
        left.append(k)
        right.append(m)
        groups.append((i, j, k + 1, m + 1))
        i, j = k + 1, m + 1
    return stretches, groups, left, right


def group_texts(stretches: list, groups: list, a: list[str], b: list[str]) -> str:
    """All groups in order as ``a1,a2|b1;a3|b2``; ``a`` has the bar behind each id."""
    made: list[str] = []
    irregular = iter(groups)
    p, q, r, t = next(irregular, END)
    for i, j, length in [*stretches, (len(a), 0, 0)]:
        while p < i:
            made.append((a[p] if r - p == 1 else ",".join(a[p:r]).replace("|,", ",")) + ",".join(b[q:t]))
            p, q, r, t = next(irregular, END)
        made.extend(map(add, a[i : i + length], b[j : j + length]))
    return ";".join(made)


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles meanwhile: a block makes many small lists and tuples, and none in a cycle."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


@dataclass
class Alignment:
    """Counts of one text, the digest of its groups, and its distinct id pairs with their links."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    digest: str = ""
    groups: str = ""
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def spread(stretches: list[tuple[int, int, int]], which: int) -> np.ndarray:
    """The token indexes of all one-to-one stretches on one side."""
    first, length = np.array([(s[which], s[2]) for s in stretches], np.int64).reshape(-1, 2).T
    return np.arange(length.sum()) + np.repeat(first - np.cumsum(length) + length, length)


class Aligner:
    """Both tokenizers, and words met before: their groups as text, the id pairs of their links and how many tokens each side has;
    and the tokens' bytes of both sides of words that either does not spell, which have nothing else."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = side(ByteLevel, path_a), side(Pieces, path_b)
        self.texts_a = [f"{i}|" for i in range(len(self.a.sizes))]
        self.texts_b = [str(i) for i in range(len(self.b.sizes))]
        self.known: dict[str, tuple[str, bytes, int, int]] = {}
        self.others: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0

    def learn(self, words: set[str]) -> None:
        """Make all these words known; when too much is held, no others stay."""
        new = list(words.difference(self.known))
        self.held += sum(map(len, new)) + ENTRY * len(new)
        if self.held > REMEMBERED_BYTES:
            self.known = {word: self.known[word] for word in words if word in self.known}
            self.others = {word: self.others[word] for word in words if word in self.others}
            self.held = sum(map(len, words)) + ENTRY * len(words) + sum(len(k[0]) + len(k[1]) for k in self.known.values())
        spelt = []
        for word, (ids_a, other_a), (ids_b, other_b) in zip(new, self.a.parts(new), self.b.parts(new)):
            if other_a is None and other_b is None:
                spelt.append((word, ids_a, ids_b))
            else:
                raw = word.encode()
                self.known[word] = "", b"", 0, 0
                self.others[word] = raw if other_a is None else other_a, raw if other_b is None else other_b
        for at in range(0, len(spelt), SEGMENT):
            self.learn_aligned(*zip(*spelt[at : at + SEGMENT]))

    def learn_aligned(self, words: tuple[str, ...], ids_a: tuple[bytes, ...], ids_b: tuple[bytes, ...]) -> None:
        """Align words that both sides spell, one behind the other, and remember each one's part."""
        a, b = (np.frombuffer(b"".join(ids), np.int32) for ids in (ids_a, ids_b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) // 4 for ids in (ids_a, ids_b))
        at, pairs, shown = self.part(a, b, (np.cumsum(n_a) - n_a).tolist())
        word = np.repeat(np.arange(len(words)), n_a)[at]
        ends = (8 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        links = pairs[np.argsort(word, kind="stable")].tobytes()
        texts = shown[1:].split(";\n")
        self.held += len(shown) + len(links)
        self.known.update(zip(words, zip(texts, [links[s:e] for s, e in zip([0, *ends], ends)], n_a.tolist(), n_b.tolist())))

    def spelt(self, words: list[str]) -> bool:
        """Whether the tokens of both sides give the words' bytes."""
        if self.others.keys().isdisjoint(words):
            return True
        given = zip(*[self.others.get(w) or (w.encode(),) * 2 for w in words])
        want = "".join(words).encode()
        return all(b"".join(parts) == want for parts in given)

    def part(self, a: np.ndarray, b: np.ndarray, marked: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, str]:
        """Of every link its A token and its id pair, and the groups as text, with a line feed before the tokens ``marked``."""
        ends = [np.cumsum(s.sizes[ids]).tolist() for s, ids in ((self.a, a), (self.b, b))]
        stretches, groups, left, right = diagonals(*ends)
        shown_a, shown_b = ([texts[i] for i in ids.tolist()] for texts, ids in ((self.texts_a, a), (self.texts_b, b)))
        for k in marked or ():
            shown_a[k] = "\n" + shown_a[k]
        shown = group_texts(stretches, groups, shown_a, shown_b)
        at_a, at_b = (np.append(spread(stretches, which), rest).astype(np.int64) for which, rest in ((0, left), (1, right)))
        return at_a, (a[at_a].astype(np.int64) << B_BITS) | b[at_b], shown

    def put_together(self, words: list[str], plain: bool) -> tuple[str, np.ndarray, int, int]:
        """Groups as text, id pairs of links and both sides' tokens of a stretch of a text; not ``plain`` if it has words that
        only their neighbours complete to the text's bytes, and then it is encoded and aligned as a whole."""
        if plain:
            texts, links, n_a, n_b = zip(*map(self.known.__getitem__, words))
            return ";".join(texts), np.frombuffer(b"".join(links), np.int64), sum(n_a), sum(n_b)
        a, b = (np.frombuffer(b"".join([ids for ids, _ in s.parts(words)]), np.int32) for s in (self.a, self.b))
        _, pairs, shown = self.part(a, b)
        return shown, pairs, len(a), len(b)

    def align(self, words: list[str], keep: bool = False) -> Alignment:
        """One text from its words, which must be known, some words at a time."""
        made = Alignment()
        if not words or not self.spelt(words):
            return made
        plain = self.others.keys().isdisjoint(words)
        digest, kept, pairs, times = hashlib.sha256(), [], [], []
        for at in range(0, len(words), SEGMENT):
            shown, met, n_a, n_b = self.put_together(words[at : at + SEGMENT], plain)
            digest.update((";" + shown if at else shown).encode())
            if keep:
                kept.append(shown)
            made.n_a += n_a
            made.n_b += n_b
            made.n_groups += shown.count("|")
            made.n_links += len(met)
            for column, values in zip((pairs, times), np.unique(met, return_counts=True)):
                column.append(values)
        made.digest, made.groups = digest.hexdigest(), ";".join(kept)
        if len(pairs) == 1:
            made.pairs, made.times = pairs[0], times[0]
        else:
            made.pairs, where = np.unique(np.concatenate(pairs), return_inverse=True)
            made.times = np.bincount(where, np.concatenate(times), len(made.pairs)).astype(np.int64)
        return made

    def align_all(self, texts: list[str], keep: bool = False) -> list[Alignment]:
        """Texts of one block; their new words are encoded together."""
        with uncollected():
            cut = [words_of(" " + text) if text else [] for text in texts]
            self.learn(set().union(*cut))
            return [self.align(words, keep) for words in cut]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """Per row its counts and the digest of its groups, with ``groups`` also the groups themselves; its block, and its pairs as
    places in the block's list and their links. The first row of a block holds that list: the distinct pairs and
    in how many of the block's documents each is linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BLOCK_BYTES):
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                made = worker.align_all(part.column(1).to_pylist(), groups)
                known, place, among = np.unique(np.concatenate([m.pairs for m in made]), return_inverse=True, return_counts=True)
                borders = np.concatenate([[0], np.cumsum([len(m.pairs) for m in made])])
                rest = [None] * (part.num_rows - 1)
                columns = [
                    part.column(0),
                    *(pa.array([getattr(m, c) for m in made], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                    pa.array([m.digest for m in made], pa.string()),
                    pa.array([number] * part.num_rows, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(place, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(np.concatenate([m.times for m in made]), pa.int32())),
                    pa.array([known, *rest], pa.list_(pa.int64())),
                    pa.array([among, *rest], pa.list_(pa.int64())),
                    *([pa.array([m.groups for m in made], pa.string())] if groups else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in shape.split(", ")])
                number += 1

    shape = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, block bigint, "
        "places array<int>, times array<int>, pairs array<bigint>, docs array<bigint>"
    ) + (", groups string" if groups else "")
    plain = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return plain.mapInArrow(rows, shape)


def pair_counts(lists: DataFrame) -> DataFrame:
    """Documents per id pair, and whether no pair of the same A id has more. An A id has at most as many pairs as B has ids."""
    counts = lists.groupBy("pair").agg(F.sum("docs").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def summed(docs: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
    """n_best and count_sum of a block's documents from its pairs' counts."""
    count, best = np.zeros((2, len(lists)), np.int64)
    count[lists["place"]], best[lists["place"]] = lists["count"], lists["best"]
    made = docs.drop(columns=["block", "places", "times"])
    made["n_best"] = [int((t * best[p]).sum()) for p, t in zip(docs["places"], docs["times"])]
    made["count_sum"] = [int((t * count[p]).sum()) for p, t in zip(docs["places"], docs["times"])]
    return made


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, with ``groups`` also groups; n_best and count_sum of every row."""
    made = fixed(aligned(docs, path_a, path_b, key, text, groups), "aligned")
    lists = made.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "of"))
    lists = lists.select("block", "place", F.col("of.pairs").alias("pair"), F.col("of.docs").alias("docs"))
    counts = fixed(pair_counts(lists), "pair-counts")
    back = lists.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "count", "best")
    per_doc = made.drop("pairs", "docs")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in per_doc.schema if f.name not in ("block", "places", "times"))
    grouped = per_doc.groupBy("block").cogroup(back.groupBy("of_block"))
    return grouped.applyInPandas(summed, f"{shape}, n_best bigint, count_sum bigint")
