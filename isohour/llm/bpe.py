"""Byte-level BPE in DuckDB, partition by partition.

Encoding: texts fall into words with the space before them, and each distinct word is treated once
per worker. The pattern cuts words into pieces, which are remembered too; pieces that are tokens are looked up, the others
are contracted by one recursive query. Its rows are (piece, position, token); each step joins
neighbouring tokens with the merge table and contracts every piece's leftmost pair of the lowest rank, until
no piece has a pair left. Decoding joins token ids with the vocabulary and aggregates their bytes in
order; it is done per distinct piece as well, in the contracting query, as the bytes of joined id lists are the joined bytes.

The merge table lists, for each token, every cut into two tokens: merging by rank of the joined
bytes is the rule of rank files. Pieces over ``LONG`` bytes contract in a loop, so that only their present state is
held, and by many pairs a step: all pairs of the lowest rank, in each run of overlapping ones every other from
the left, and every pair that nothing can come before. A token may only be taken from its pair (t, next) by a merge with
a token X to its left that ends as its left neighbours do, or in the same way on the right. Where the lowest rank of
all such merges in the vocabulary is not below the pair's (on the left: is above), the pair will be contracted as it is,
and so it is at once. Only a token's own last merge (that of the token encoded alone) can ever make it, which needs
every token to encode to itself by rising ranks; this is checked, and other files contract long pieces one pair a step.

Defined results: null and empty texts have no ids and decode to no bytes. Unpaired surrogates cannot
occur in Spark's strings. Repeated rows are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, functions as F

from isohour.llm.common import slices

LONG = 256
LONG_BYTES = 1 << 18  # long pieces that contract together
GROUP = 50_000  # pieces of one recursive query
REMEMBERED = 1_600_000  # chunks and pieces whose ids a worker keeps
BATCH_BYTES = 4 << 20

#: White space as the patterns of rank files see it.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Chunks that the pattern never crosses: white space but its last character, or a word with the space before it.
CHUNK = re.compile(f"[{BLANK}]+(?![^{BLANK}])| ?[^{BLANK}]+|[{BLANK}]+")

#: One contraction of every piece in {rows}. Rows hold the token, the next one and its position. The
#: lowest rank and its leftmost position are one number per piece: rank, position, next position.
STEP = """
SELECT s.step + 1 AS step, s.w, s.p,
       CASE WHEN s.p = c.p THEN c.after_next ELSE s.np END AS np,
       CASE WHEN s.p = c.p THEN c.m ELSE s.t END AS t,
       CASE WHEN s.p = c.p THEN c.after_token WHEN s.np = c.p THEN c.m ELSE s.nt END AS nt
FROM {rows} s JOIN (
  SELECT b.w, (best >> 20) & 1048575 AS p, (best >> 40)::INTEGER AS m, best & 1048575 AS np,
         g.np AS after_next, g.nt AS after_token
  FROM (SELECT w, min((m::BIGINT << 40) | (p::BIGINT << 20) | np) AS best
        FROM {rows} JOIN merges ON t = l AND nt = r GROUP BY w) b
  JOIN {rows} g ON g.w = b.w AND g.p = best & 1048575) c ON s.w = c.w
WHERE s.p <> c.np
"""
CONTRACT = f"""
WITH RECURSIVE state(step, w, p, np, t, nt) AS (
  SELECT * FROM pieces UNION ALL {STEP.format(rows="state")}
)
SELECT w, string_agg(shown, ',' ORDER BY p) AS shown, unhex(string_agg(hexed, '' ORDER BY p)) AS bytes
FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step) JOIN vocabulary ON id = t GROUP BY w ORDER BY w
"""
#: The same result by many pairs a step, for rows (w, p, t, b), b the token's bytes. ``left_threats`` and
#: ``right_threats`` hold the lowest rank of merges of a token with any token that ends, or begins, like its two present neighbours.
MANY = """
CREATE OR REPLACE TEMP TABLE stepped AS
WITH near AS (
  SELECT w, p, t, b, lag(b, 2) OVER a || lag(b) OVER a AS before, lead(t) OVER a AS nt,
         lead(b, 2) OVER a || lead(b, 3) OVER a AS after, row_number() OVER a AS i
  FROM pieces WINDOW a AS (PARTITION BY w ORDER BY p)
), ranked AS (
  SELECT n.*, m.m, m.b AS mb, lag(m.m) OVER a AS left_m, lead(m.m) OVER a AS right_m, min(m.m) OVER (PARTITION BY n.w) AS least
  FROM near n LEFT JOIN own_merges m ON n.t = m.l AND n.nt = m.r WINDOW a AS (PARTITION BY n.w ORDER BY n.i)
), pairs AS (
  SELECT n.w, n.i, n.m, n.mb, n.least, n.m < coalesce(least(n.left_m, x.m), n.m + 1) AND n.m <= coalesce(least(n.right_m, y.m), n.m) AS safe
  FROM ranked n LEFT JOIN left_threats x ON x.tail = n.before AND x.t = n.t
  LEFT JOIN right_threats y ON y.t = n.nt AND y.head = n.after
  WHERE n.m IS NOT NULL
), runs AS (
  SELECT w, i, m, mb, i - row_number() OVER (PARTITION BY w ORDER BY i) AS run FROM pairs WHERE m = least
), picked AS ({picked})
SELECT n.w, n.p, coalesce(k.m, n.t) AS t, coalesce(k.mb, n.b) AS b
FROM near n LEFT JOIN picked k ON k.w = n.w AND k.i = n.i ANTI JOIN picked g ON g.w = n.w AND g.i = n.i - 1
"""
PICK_MANY = """
  SELECT w, i, m, mb FROM (SELECT w, i, m, mb, row_number() OVER (PARTITION BY w, run ORDER BY i) % 2 AS odd FROM runs) WHERE odd = 1
  UNION ALL SELECT w, i, m, mb FROM pairs WHERE safe AND m > least
"""
PICK_ONE = "SELECT w, min(i) AS i, min(m) AS m, arg_min(mb, i) AS mb FROM runs GROUP BY w"
DECODE = """
SELECT doc, string_agg(hexed, '' ORDER BY pos) AS hexed
FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


class Bpe:
    """A vocabulary of ranks, loaded into an own DuckDB of one thread."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        # Of chunks and of pieces: the ids as text, and the bytes decoded from them.
        self.shown: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        self.piece_shown: dict[str, str] = {}
        self.piece_raw: dict[str, bytes] = {}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.merges = merges = [
            (self.ranks[token[:cut]], self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        ]
        self.long_step = ""
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        left, right, merged = (pa.array(c, pa.int32()) for c in zip(*merges))
        self.load("merges", pa.table({"l": left, "r": right, "m": merged}))
        ids, tokens = pa.array(self.ranks.values(), pa.int32()), pa.array(self.ranks.keys(), pa.binary())
        self.load("tokens", pa.table({"id": ids, "bytes": tokens}))
        self.db.execute("CREATE TEMP TABLE vocabulary AS SELECT id, id::VARCHAR AS shown, hex(bytes) AS hexed FROM tokens")

    def load(self, name: str, table: pa.Table) -> None:
        self.db.register("arriving", table)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM arriving")
        self.db.unregister("arriving")

    def contract(self, pieces: list[bytes]) -> tuple[list[str], list[bytes]]:
        """Of every piece the token ids as text, and the bytes decoded from them."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        p = (np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        last = np.zeros(len(tokens), bool)
        last[ends - 1] = True
        after = pa.array(p + 1, mask=last), pa.array(np.roll(tokens, -1), mask=last)
        step = np.zeros(len(tokens), np.int32)
        self.load("pieces", pa.table({"step": step, "w": w, "p": p, "np": after[0], "t": tokens, "nt": after[1]}))
        found = self.db.sql(CONTRACT).to_arrow_table()
        return found.column("shown").to_pylist(), found.column("bytes").to_pylist()

    def last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that make this one when it is encoded alone, if ranks rise up to its own."""
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, k = min((self.ranks.get(parts[k] + parts[k + 1], rank), k) for k in range(len(parts) - 1))
            if best >= rank:
                return None
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        left, right = (self.ranks[part] for part in parts)
        return (left, right) if max(left, right) < rank else None

    def load_long(self) -> str:
        """Tables for long pieces, and the statement of one step."""
        found = [(self.last_merge(token, rank), rank) for token, rank in self.ranks.items() if len(token) > 1]
        regular = all(pair for pair, _ in found)
        merges = [(*pair, rank) for pair, rank in found] if regular else self.merges
        tokens = {rank: token for token, rank in self.ranks.items()}
        left: dict[tuple[bytes, int], int] = {}
        right: dict[tuple[bytes, int], int] = {}
        for a, b, m in merges:
            for k in range(len(tokens[a]) - 1):
                tail = tokens[a][k:], b
                left[tail] = min(m, left.get(tail, m))
            for k in range(2, len(tokens[b]) + 1):
                head = tokens[b][:k], a
                right[head] = min(m, right.get(head, m))
        columns = [pa.array(c, pa.int32()) for c in zip(*merges)]
        self.load("own_merges", pa.table([*columns, pa.array([tokens[m] for _, _, m in merges], pa.binary())], ["l", "r", "m", "b"]))
        for name, part, threats in (("left_threats", "tail", left), ("right_threats", "head", right)):
            texts, others = zip(*threats)
            ranks = pa.array(threats.values(), pa.int32())
            self.load(name, pa.table([pa.array(texts, pa.binary()), pa.array(others, pa.int32()), ranks], [part, "t", "m"]))
        return MANY.format(picked=PICK_MANY if regular else PICK_ONE)

    def contract_long(self, pieces: list[bytes]) -> tuple[list[str], list[bytes]]:
        """As ``contract``, by many pairs a step."""
        self.long_step = self.long_step or self.load_long()
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        left = len(raw)
        w, p = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes), np.arange(left, dtype=np.int64)
        self.load("pieces", pa.table({"w": w, "p": p, "t": self.byte_ids[raw], "b": pa.array([bytes([x]) for x in raw.tolist()], pa.binary())}))
        while True:
            self.db.execute(self.long_step)
            now = self.db.sql("SELECT count(*) FROM stepped").fetchall()[0][0]
            self.db.execute("DROP TABLE pieces; ALTER TABLE stepped RENAME TO pieces")
            if now == left:
                break
            left = now
        found = self.db.sql("SELECT w, t FROM pieces ORDER BY w, p").to_arrow_table()
        counts = np.bincount(found.column("w").to_numpy(), minlength=len(pieces))
        return self.entries(found.column("t").to_numpy(), np.concatenate([[0], np.cumsum(counts)]))

    def entries(self, flat: np.ndarray, borders: np.ndarray) -> tuple[list[str], list[bytes]]:
        """Per list of ids: them as text, and the bytes decoded from them."""
        raw, raw_borders = self.decoded(flat, borders)
        texts, ends, raw_ends = list(map(str, flat.tolist())), borders.tolist(), raw_borders.tolist()
        shown = [",".join(texts[start:end]) for start, end in zip(ends, ends[1:])]
        return shown, [raw[start:end] for start, end in zip(raw_ends, raw_ends[1:])]

    def learn_pieces(self, pieces: set[str]) -> None:
        """Make pieces known: those that are tokens by look-up, the others contracted."""
        tokens, short, long = [], [], []
        for piece in pieces:
            raw = piece.encode()
            (tokens if raw in self.ranks else short if len(raw) <= LONG else long).append((piece, raw))

        def keep(some: list[tuple[str, bytes]], found: tuple[list[str], list[bytes]]) -> None:
            names = [piece for piece, _ in some]
            self.piece_shown.update(zip(names, found[0]))
            self.piece_raw.update(zip(names, found[1]))

        keep(tokens, self.entries(np.array([self.ranks[raw] for _, raw in tokens], np.int32), np.arange(len(tokens) + 1)))
        groups = [(short[i : i + GROUP], self.contract) for i in range(0, len(short), GROUP)]
        held = LONG_BYTES
        for piece, raw in long:
            if held + len(raw) > LONG_BYTES:
                groups.append(([], self.contract_long))
                held = 0
            groups[-1][0].append((piece, raw))
            held += len(raw)
        for some, way in groups:
            keep(some, way([raw for _, raw in some]))

    def learn(self, chunks: set[str]) -> None:
        """Make the ids of these chunks and the bytes they decode to known."""
        match, whole, cut = self.pattern.match, [], {}
        for chunk in chunks:
            first = match(chunk)
            if first and first.end() == len(chunk):
                whole.append(chunk)
            else:
                cut[chunk] = self.pattern.findall(chunk)
        self.learn_pieces(set(whole).union(*cut.values()).difference(self.piece_shown))
        shown, raw = self.piece_shown.__getitem__, self.piece_raw.__getitem__
        self.shown.update(zip(whole, map(shown, whole)))
        self.raw.update(zip(whole, map(raw, whole)))
        for chunk, parts in cut.items():
            self.shown[chunk] = ",".join(map(shown, parts))
            self.raw[chunk] = b"".join(map(raw, parts))

    def chunks(self, texts: Iterable[str | None]) -> list[list[str]]:
        """Each text as a list of chunks, all made known."""
        cut = [CHUNK.findall(text) if text else [] for text in texts]
        wanted = set().union(*cut)
        new = wanted.difference(self.shown)
        if len(self.shown) + len(self.piece_shown) + 2 * len(new) > REMEMBERED:  # what these texts use stays
            self.shown, self.raw, self.piece_shown, self.piece_raw = (
                {name: known[name] for name in wanted if name in known} for known in (self.shown, self.raw, self.piece_shown, self.piece_raw)
            )
        self.learn(new)
        return cut

    def id_text(self, chunks: list[str]) -> str:
        """The ids of known chunks, joined by commas."""
        return ",".join(map(self.shown.__getitem__, chunks))

    def id_bytes(self, chunks: list[str]) -> bytes:
        """The bytes decoded from the ids of known chunks."""
        return b"".join(map(self.raw.__getitem__, chunks))

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.array(self.id_text(chunks).split(",") if chunks else [], np.int32) for chunks in self.chunks(texts)]

    def decoded(self, flat: np.ndarray, borders: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of lists of ids, one after the other, and the border of each among them."""
        doc = np.repeat(np.arange(len(borders) - 1, dtype=np.int32), np.diff(borders))
        self.load("ids", pa.table({"doc": doc, "pos": np.arange(len(flat), dtype=np.int64), "id": flat}))
        found = self.db.sql(DECODE).to_arrow_table()
        sizes = np.zeros(len(borders) - 1, np.int64)
        sizes[found.column("doc").to_numpy()] = pa.compute.binary_length(found.column("hexed")).to_numpy() // 2
        return bytes.fromhex("".join(found.column("hexed").to_pylist())), np.concatenate([[0], np.cumsum(sizes)])

    def decode(self, documents: list[np.ndarray]) -> list[bytes]:
        """Bytes of each list of ids."""
        flat = np.concatenate([np.zeros(0, np.int32), *documents])
        raw, borders = self.decoded(flat, np.cumsum([0, *map(len, documents)]))
        return [raw[start:end] for start, end in zip(borders.tolist(), borders[1:].tolist())]


_loaded: dict[tuple[str, str], Bpe] = {}


def bpe(path: str, pattern: str) -> Bpe:
    """The worker's own copy; the file is read once per worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(path, pattern)
    return _loaded[path, pattern]


def batches_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path, pattern)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids = coder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return batches_of(docs).mapInArrow(rows, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, the number of ids, the ids as text and the bytes they stand for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = [np.asarray(x.values) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(coder.decode(lists), pa.binary())], ["doc_id", "bytes"])

    return encoded.mapInArrow(rows, "doc_id bigint, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path, pattern)
        for batch in slices(batches, "text", BATCH_BYTES):
            n, ids, raw = [], [], []
            for chunks in coder.chunks(batch.column(1).to_pylist()):
                shown = coder.id_text(chunks)
                n.append(shown.count(",") + 1 if shown else 0)
                ids.append(hashlib.sha256(shown.encode()).hexdigest())
                raw.append(hashlib.sha256(coder.id_bytes(chunks)).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    shape = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return batches_of(docs).mapInArrow(rows, shape)
