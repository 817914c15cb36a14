"""Near-duplicate vectors by int8 tile products with error bounds.

Vectors are scaled to unit length and quantised to int8 with one scale each; the length ``e`` of what
quantisation lost is measured per vector. For unit vectors x, y and their quantised forms p, q the true product
differs from the quantised one by at most

    |x.y - p.q| <= |p| e_y + |q| e_x + e_x e_y

so a tile product decides most pairs: surely below, surely above, or open. Only open pairs are computed again
in double precision. Equal vectors of a label are one class beforehand, with its size. Classes of a
label are dealt to tiles of at most about ``tile`` vectors by the signs of fixed random directions; two tiles meet
only if the angle between their centres minus both radii allows the threshold. A tile pair returns the
number of links per class and a spanning forest of the links, not the links, so a group of n
similar vectors returns a number of rows that grows with tiles times n.

Defined results: a null label links with nothing, nor do vectors that are null, empty, zero or hold a
null or non-finite component, nor vectors of different lengths. Ties at the threshold link. Repeated
rows are vectors of their own and count as links of each other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from isohour.llm.common import fixed
from isohour.llm.components import components

ROUNDING = 1e-6  # float32 sums of int8 products and unit scaling, far above their real error
MOST_BITS = 16


def codes(vectors: np.ndarray, bits: int, seed: int = 11) -> np.ndarray:
    """Signs along fixed random directions as a number."""
    directions = np.random.default_rng(seed).normal(size=(MOST_BITS, vectors.shape[1]))[:bits]
    return ((vectors @ directions.T > 0) << np.arange(bits)).sum(axis=1).astype(np.int64)


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, a scale each, and the length of each quantisation error."""
    scale = np.abs(unit).max(axis=1) / 127
    small = np.rint(unit / scale[:, None]).astype(np.int8)
    return small, scale, np.linalg.norm(unit - small * scale[:, None], axis=1)


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows have a cosine of at least the threshold."""
    size_x, size_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    (p, sp, ep), (q, sq, eq) = quantised(x / size_x[:, None]), quantised(y / size_y[:, None])
    product = (p.astype(np.float32) @ q.astype(np.float32).T).astype(np.float64) * sp[:, None] * sq[None, :]
    length_p = np.linalg.norm(p * sp[:, None], axis=1)
    length_q = np.linalg.norm(q * sq[:, None], axis=1)
    bound = length_p[:, None] * eq[None, :] + ep[:, None] * length_q[None, :] + ep[:, None] * eq[None, :] + ROUNDING
    sure = product - bound >= threshold
    i, j = np.nonzero((product + bound >= threshold) & ~sure)
    for part in range(0, len(i), 100_000):
        a, b = i[part : part + 100_000], j[part : part + 100_000]
        exact = np.einsum("nd,nd->n", x[a], y[b]) / (size_x[a] * size_y[b])
        sure[a, b] = exact >= threshold
    return sure


def forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """A spanning forest of the pairs among n nodes."""
    root = list(range(n))

    def top(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    kept = []
    for a, b in pairs.tolist():
        ra, rb = top(a), top(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def unpacked(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, "<f4").reshape(-1, width).astype(np.float64)


def tile_links(frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Rows (id, other, n): links per class with ``other`` null, and forest edges with ``n`` null."""
    for frame in frames:
        for row in frame.itertuples():
            x, ids = unpacked(row.x, row.width), np.frombuffer(row.x_ids, "<i8")
            sizes = np.frombuffer(row.x_sizes, "<i8")
            same = row.x_tile == row.y_tile
            y, other_ids, other_sizes = (x, ids, sizes) if same else (
                unpacked(row.y, row.width), np.frombuffer(row.y_ids, "<i8"), np.frombuffer(row.y_sizes, "<i8"))
            hit = linked(x, y, threshold)
            if same:
                hit = hit | hit.T
                np.fill_diagonal(hit, False)
                count = [(ids, hit @ sizes)]
                edges = forest(np.argwhere(np.triu(hit)), len(ids))
                edges = np.stack([ids[edges[:, 0]], ids[edges[:, 1]]], axis=1)
            else:
                count = [(ids, hit @ other_sizes), (other_ids, sizes @ hit)]
                edges = forest(np.argwhere(hit) + [0, len(ids)], len(ids) + len(other_ids))
                edges = np.stack([ids[edges[:, 0]], other_ids[edges[:, 1] - len(ids)]], axis=1)
            made = [pd.DataFrame({"id": i[n > 0], "other": pd.NA, "n": n[n > 0]}) for i, n in count]
            made.append(pd.DataFrame({"id": edges[:, 0], "other": edges[:, 1], "n": pd.NA}))
            yield pd.concat(made).astype({"id": "int64", "other": "Int64", "n": "Int64"})


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tile: int = 512, pairs_a_task: int = 24) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<float>").alias("v"))
    sound = (
        F.col("label").isNotNull()
        & F.exists("v", lambda c: c != 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    valid = rows.where(F.coalesce(sound, F.lit(False)))
    # -0.0 and 0.0 are one value to arithmetic and to grouping.
    classes = valid.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))

    def with_code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            code = np.zeros(len(frame), np.int64)
            for width, part in frame.groupby(frame["v"].map(len)):
                code[frame.index.get_indexer(part.index)] = codes(np.array(part["v"].tolist(), np.float64), MOST_BITS)
            yield frame.assign(code=code, width=frame["v"].map(len).astype(np.int32))

    label = classes.schema["label"].dataType.simpleString()
    shape = f"label {label}, v array<float>, id bigint, n bigint"
    coded = fixed(classes.mapInPandas(with_code, f"{shape}, code bigint, width int"), "vector-classes")
    totals = coded.groupBy("label", "width").agg(F.count("*").alias("total"))
    bits = F.greatest(F.lit(0), F.least(F.lit(MOST_BITS), F.floor(F.log2(F.col("total") / tile)))).cast("int")
    cell = coded.join(totals.select("label", "width", bits.alias("bits")), ["label", "width"])
    cell = cell.withColumn("cell", F.col("code") % F.pow(F.lit(2), F.col("bits")).cast("bigint"))
    filled = cell.groupBy("label", "width", "cell").agg(F.count("*").alias("filled"))
    cell = cell.join(filled, ["label", "width", "cell"])
    cut = F.pmod(F.xxhash64("id"), F.ceil(F.col("filled") / tile))
    tiled = cell.select("label", "width", F.struct("cell", cut.alias("cut")).alias("tile"), "id", "n", "v")

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        x = np.array(frame["v"].tolist(), "<f4")
        unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
        centre = unit.mean(axis=0)
        length = np.linalg.norm(centre)
        centre = centre / length if length > 1e-9 else np.eye(1, len(centre))[0]
        radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max()) + 1e-6
        first = frame.iloc[0]
        ids, sizes = frame["id"].to_numpy("<i8").tobytes(), frame["n"].to_numpy("<i8").tobytes()
        made = [first["label"], first["width"], f"{first['tile']['cell']}-{first['tile']['cut']}", centre.tolist(), radius, x.tobytes(), ids, sizes]
        return pd.DataFrame([made], columns=["label", "width", "tile", "centre", "radius", "x", "x_ids", "x_sizes"])

    kinds = f"label {label}, width int, tile string, centre array<double>, radius double, x binary, x_ids binary, x_sizes binary"
    tiles = fixed(tiled.groupBy("label", "width", "tile").applyInPandas(packed, kinds), "vector-tiles")
    outline = tiles.select("label", "width", "tile", "centre", "radius")
    other = outline.select("label", "width", F.col("tile").alias("y_tile"), F.col("centre").alias("y_centre"), F.col("radius").alias("y_radius"))
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.aggregate(F.zip_with("centre", "y_centre", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b))))
    reach = float(np.arccos(threshold)) + 1e-6
    meets = (F.col("tile") == F.col("y_tile")) | (between - F.col("radius") - F.col("y_radius") <= reach)
    pairs = outline.join(other, ["label", "width"]).where((F.col("tile") <= F.col("y_tile")) & meets).select("label", "width", F.col("tile").alias("x_tile"), "y_tile")
    pairs = fixed(pairs, "vector-tile-pairs")
    left = tiles.select("label", "width", F.col("tile").alias("x_tile"), "x", "x_ids", "x_sizes")
    right = tiles.select("label", "width", F.col("tile").alias("y_tile"), F.col("x").alias("y"), F.col("x_ids").alias("y_ids"), F.col("x_sizes").alias("y_sizes"))
    dealt = pairs.join(left, ["label", "width", "x_tile"]).join(right, ["label", "width", "y_tile"])
    dealt = dealt.repartition(max(1, -(-pairs.count() // pairs_a_task)), "label", "width", "x_tile", "y_tile")
    wanted = dealt.select("width", "x_tile", "y_tile", "x", "x_ids", "x_sizes", "y", "y_ids", "y_sizes")
    found = fixed(wanted.mapInPandas(lambda frames: tile_links(frames, threshold), "id bigint, other bigint, n bigint"), "vector-links")

    degree = found.where("n IS NOT NULL").groupBy("id").agg(F.sum("n").alias("outside"))
    reached = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = coded.select("label", "v", "id", "n").join(degree, "id", "left").join(reached, "id", "left")
    of_class = of_class.select(
        "label", "v",
        (F.coalesce("outside", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("component", "id").alias("reached"),
    )
    joined = rows.join(of_class, ["label", "v"], "left")
    component = F.coalesce("reached", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
