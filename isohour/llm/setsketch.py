"""Near-duplicate documents by SetSketch registers, banded, estimated by likelihood, then verified.

A register is the least of exponentially distributed hash values of a set, kept as a truncated number
on a scale of base ``BASE``: sketches merge by maximum and equal registers mark similar sets. Steps:

1. Documents of equal sets are one class from the start.
2. Bands of five registers put classes into buckets. Each bucket's hub is its member of the largest buckets
   in all, which in a group of near copies is close to their common original.
3. Members are compared with their hubs only: first by the joint likelihood of their registers,
   then on the full sets. Confirmed links join classes into components.
4. Members of one hub that are in different components have not met. They are packed into tiles, and tiles
   with members outside the hub's component are compared with all tiles of that hub, exactly. A tile pair returns a
   spanning forest of the links it finds, so no step returns the pairs of a group.

At a similarity of 0.8 two sets miss every band with a probability of about 3 in a million.

Defined results: null texts and texts without words have an empty set, are linked with nothing and are their
own component. Repeated rows of one doc_id are one document. Rows without doc_id join the class of an
equal set, else they have no component and are kept. Ties (similarity exactly at the threshold)
link. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import Copy, fixed, passing, slices
from isohour.llm.components import components
from isohour.llm.shingles import shingles
from isohour.llm.vectors import forest

BASE, RATE, TOP = 1.001, 20.0, 65534
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
BATCH_BYTES = 4 << 20
CHUNK = 1 << 16  # shingles hashed at once
TILE_SETS, TILE_SHINGLES = 256, 1 << 17
ODDS = 15.0  # a pair is dropped unverified if its registers are e**15 times likelier below the threshold
_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 2**64, REGISTERS, np.uint64)
_TIMES = _rng.integers(0, 2**64, REGISTERS, np.uint64) | np.uint64(1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each non-empty set."""
    least = np.empty((len(sets), REGISTERS), np.uint64)
    start = 0
    while start < len(sets):
        end, held = start + 1, len(sets[start])
        while end < len(sets) and held + len(sets[end]) <= CHUNK:
            held += len(sets[end])
            end += 1
        values = np.concatenate(sets[start:end])
        offsets = np.cumsum([0, *map(len, sets[start : end - 1])])
        for r in range(REGISTERS):
            least[start:end, r] = np.minimum.reduceat((values ^ _XOR[r]) * _TIMES[r], offsets)
        start = end
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def sketch_table(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, digest of the set and registers; the last two are null for an empty set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            full = [s for s in sets if len(s)]
            registers = iter(sketches(full)) if full else iter(())
            signs = [next(registers).tobytes() if len(s) else None for s in sets]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "registers"])

    return docs.mapInArrow(rows, "doc_id bigint, n bigint, digest binary, registers binary")


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether registers allow a similarity of at least ``threshold``, by maximum likelihood.

    With shares u and v of both sizes, a register of one set exceeds the other's with probability
    p(u - v J) and p(v - u J), p(x) = -log_b(1 - x (b - 1) / b), and both are equal otherwise.
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101)
    best = {True: np.full(len(a), -np.inf), False: np.full(len(a), -np.inf)}
    chance = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    for j in grid:
        s = np.minimum(j, most)
        up, down = np.clip(chance(u - v * s), 1e-9, 1), np.clip(chance(v - u * s), 1e-9, 1)
        value = above * np.log(up) + below * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-9, 1))
        side = bool(j >= threshold - 1e-9)
        best[side] = np.maximum(best[side], np.where(j <= most + 0.01, value, -np.inf))
    return best[True] >= best[False] - ODDS


def similar(common: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n_a + n_b - common)


def confirmed(pairs: DataFrame, known: DataFrame, texts: DataFrame, percent: int, width: int, held: Copy) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough."""
    left = known.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = known.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    sized = pairs.join(left, "a").join(right, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def plausible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                a, b = (np.frombuffer(b"".join(frame[c]), "<u2").reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
                yield frame.loc[likely(a, b, frame["n_a"].to_numpy(), frame["n_b"].to_numpy(), percent / 100), ["a", "b"]]

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_b, last_set = None, None
        for frame in frames:
            keep = []
            for a_text, b, b_text in zip(frame["a_text"], frame["b"], frame["b_text"]):
                if b != last_b:
                    last_b, last_set = b, shingles(b_text, width)
                own = shingles(a_text, width)
                n = len(np.intersect1d(own, last_set, assume_unique=True))
                keep.append(bool(similar(n, len(own), len(last_set), percent)))
            yield frame.loc[keep, ["a", "b"]]

    wanted = held(sized.mapInPandas(plausible, "a bigint, b bigint"), "plausible-pairs")
    text = texts.select("id", "text")
    both = wanted.join(text.select(F.col("id").alias("a"), F.col("text").alias("a_text")), "a")
    both = both.join(text.select(F.col("id").alias("b"), F.col("text").alias("b_text")), "b")
    return both.mapInPandas(exact, "a bigint, b bigint")


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, as products of 0/1 matrices."""
    words, at = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    ends = np.cumsum([0, *map(len, x), *map(len, y)])
    who = np.repeat(np.arange(len(x) + len(y)), np.diff(ends))
    total = np.zeros((len(x), len(y)), np.float64)
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    for low in range(0, len(words), 8192):
        left, right = np.searchsorted(at, [low, low + 8192])
        dense = np.zeros((len(x) + len(y), min(8192, len(words) - low)), np.float32)
        dense[who[left:right], at[left:right] - low] = 1
        total += dense[: len(x)] @ dense[len(x) :].T
    return total.astype(np.int64)


def unmet(clusters: DataFrame, texts: DataFrame, percent: int, width: int, held: Copy) -> DataFrame:
    """Links (a, b) between members (hub, id, component, minor) of one hub that differ in component.

    Only members whose component is not the hub's (minor) have anybody left to meet.
    """
    spread = F.greatest(F.ceil(F.count("*") / TILE_SETS), F.ceil(F.sum("n") / TILE_SHINGLES))
    parts = clusters.groupBy("hub", "minor").agg(spread.alias("parts"))
    open_hubs = clusters.groupBy("hub").agg(F.sum(F.col("minor").cast("int")).alias("minors"), F.count("*").alias("all"))
    open_hubs = open_hubs.where("minors > 0 AND all > 1").select("hub")
    placed = clusters.join(open_hubs, "hub").join(parts, ["hub", "minor"])
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    placed = placed.join(texts.select("id", "text"), "id").select("hub", "minor", "tile", "id", "component", "text")

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        sets = [shingles(t, width) for t in frame["text"]]
        first = frame.iloc[0]
        sizes, values = np.array([len(s) for s in sets], "<i8"), np.concatenate(sets)
        made = [first["hub"], first["minor"], first["tile"], frame["id"].to_numpy("<i8").tobytes(), frame["component"].to_numpy("<i8").tobytes(), sizes.tobytes(), values.tobytes()]
        return pd.DataFrame([made], columns=["hub", "minor", "tile", "ids", "components", "sizes", "hashes"])

    kinds = "hub bigint, minor boolean, tile int, ids binary, components binary, sizes binary, hashes binary"
    tiles = held(placed.groupBy("hub", "minor", "tile").applyInPandas(packed, kinds), "set-tiles")
    x = tiles.where("minor").select("hub", *[F.col(c).alias(f"x_{c}") for c in ("tile", "ids", "components", "sizes", "hashes")])
    y = tiles.select("hub", "minor", *[F.col(c).alias(f"y_{c}") for c in ("tile", "ids", "components", "sizes", "hashes")])
    meets = ~F.col("minor") | (F.col("x_tile") <= F.col("y_tile"))
    pairs = x.select("hub", "x_tile").join(y.select("hub", "minor", "y_tile"), "hub").where(meets)
    pairs = pairs.repartition(max(1, -(-pairs.count() // 8)), "hub", "x_tile", "minor", "y_tile")
    both = pairs.join(x, ["hub", "x_tile"]).join(y, ["hub", "minor", "y_tile"])

    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                side = {}
                for name in "xy":
                    ids, comps, sizes = (np.frombuffer(getattr(row, f"{name}_{c}"), "<i8") for c in ("ids", "components", "sizes"))
                    hashes = np.split(np.frombuffer(getattr(row, f"{name}_hashes"), "<u8"), np.cumsum(sizes)[:-1])
                    side[name] = ids, comps, sizes, hashes
                (a, comp_a, n_a, sets_a), (b, comp_b, n_b, sets_b) = side["x"], side["y"]
                hit = similar(common_counts(sets_a, sets_b), n_a[:, None], n_b[None, :], percent) & (comp_a[:, None] != comp_b[None, :])
                edges = forest(np.argwhere(hit) + [0, len(a)], len(a) + len(b))
                yield pd.DataFrame({"a": a[edges[:, 0]], "b": b[edges[:, 1] - len(a)]})

    return both.mapInPandas(links, "a bigint, b bigint")


def band_keys(registers: Column) -> Column:
    size = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(k), F.substring(registers, 1 + k * size, size)) for k in range(BANDS)])


def linked(rows: DataFrame, known: DataFrame, percent: int, width: int, held: Copy) -> DataFrame:
    """(id, component) of the classes that are linked. ``held`` copies what is read again."""
    bands = known.where("id IS NOT NULL").select("id", F.explode(band_keys(F.col("registers"))).alias("bucket"))
    full = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = held(bands.join(full, "bucket"), "bucket-members")
    central = members.groupBy("id").agg(F.sum("size").alias("met"))
    ranked = members.join(central, "id")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("met", -F.col("id"))).alias("top")).select("bucket", (-F.col("top.col2")).alias("hub"))
    spokes = held(members.join(hubs, "bucket").where("id <> hub").select("id", "hub").distinct(), "spokes")
    texts = held(rows.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id").select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"]), "member-texts")

    direct = held(confirmed(spokes.select(F.col("id").alias("a"), F.col("hub").alias("b")), known, texts, percent, width, held), "links")
    first = held(components(direct), "first-components")
    of_hub = first.select(F.col("id").alias("hub"), F.col("component").alias("hub_component"))
    sizes = known.select("id", "n")
    clusters = spokes.join(first, "id", "left").join(of_hub, "hub", "left").join(sizes, "id")
    own = F.coalesce("component", "id")
    clusters = clusters.select("hub", "id", "n", own.alias("component"), (own != F.coalesce("hub_component", "hub")).alias("minor"))
    late = held(unmet(held(clusters, "clusters"), texts, percent, width, held), "late-links")
    return components(direct.unionByName(late))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketched = fixed(sketch_table(rows, width), "sketches")
    classes = sketched.where("digest IS NOT NULL").groupBy("digest", "n", "registers").agg(F.min("doc_id").alias("id"))
    known = fixed(classes, "set-classes")
    with passing(docs.sparkSession) as held:
        final = linked(rows, known, percent, width, held)

    of_class = known.select("digest", "id").join(final, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    component = F.coalesce("component", "doc_id")
    return sketched.join(of_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")
    )
