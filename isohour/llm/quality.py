"""Quality classifier: document statistics, random Fourier features, ridge, isotonic calibration.

``cos(x W + b)`` with Gaussian ``W`` approximates a Gaussian kernel over standardised statistics of
the whole text. The normal equations are sums over labelled rows: every partition adds up its own,
a second step adds those block by block, and the driver solves one system of fixed size. A part of
the labelled rows is held back from the fit; their binned scores give an isotonic calibration.

Defined results: null and empty texts have zero statistics and a score like any other. Repeated rows
are scored each. A document with several labels trains on each of them. Without labelled rows
the score is 0.5 for all. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import fixed, forget

SYMBOLS = b"#*$%&|<>"
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "newlines", "symbols", "pipes",
    "exclaims", "stops", "commas", "other_marks", "non_ascii", "distinct_words", "top_word", "distinct_pairs",
    "repeated_lines", "line_words", "compression", "long_words", "short_words", "marked_words", "top_byte",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of STATISTICS."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw.strip():
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, words = len(raw), raw.split()
    n = len(words)
    often = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    marks = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    symbols = sum(int(count[c]) for c in SYMBOLS)
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    packed = zlib.compressobj(1)
    squeezed = sum(len(packed.compress(raw[i : i + (1 << 20)])) for i in range(0, size, 1 << 20)) + len(packed.flush())
    ends = np.fromiter((w[-1] for w in words), np.uint8, n)
    return [
        np.log1p(size), np.log1p(n), lengths.mean(), count[65:91].sum() / size, count[48:58].sum() / size,
        count[32] / size, count[10] / size, symbols / size, count[124] / size, count[33] / size, count[46] / size,
        count[44] / size, (marks - symbols - count[33] - count[46] - count[44]) / size, count[128:].sum() / size,
        len(often) / n, max(often.values()) / n, pairs, 1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)), squeezed / size, (lengths > 20).mean(), (lengths <= 3).mean(),
        np.isin(ends, np.frombuffer(SYMBOLS + b"!?.,;:", np.uint8)).mean(), count.max() / size,
    ]


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and one array of statistics per row; reads every text whole, batch by batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            made = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "stats"])

    kept = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return kept.mapInArrow(rows, "doc_id bigint, stats array<double>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores, rising
    levels: np.ndarray  # calibrated scores at those

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.cos(z @ self.waves + self.phases) * np.sqrt(2 / self.waves.shape[1])
        return np.hstack([wave, z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.levels), 0.0, 1.0)


def isotonic(labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted means that never fall: pool adjacent violators."""
    blocks: list[list[float]] = []
    for y, w in zip(labels, weights):
        blocks.append([y, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y1, w1, n1 = blocks.pop()
            y0, w0, n0 = blocks.pop()
            blocks.append([(y0 * w0 + y1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(n, y) for y, _, n in blocks])


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), len(STATISTICS))


def normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of x x' and x y over rows of (stats, label), one matrix row per result row."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                x = model.features(matrix(frame["stats"]))
                add = x.T @ np.hstack([x, frame["label"].to_numpy(np.float64)[:, None]])
                total = add if total is None else total + add
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "row": list(total)})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.add.reduce([np.asarray(r) for r in frame["row"]])
        return pd.DataFrame({"i": [frame["i"].iloc[0]], "row": [total]})

    shape = "i bigint, row array<double>"
    sums = labelled.select("stats", "label").mapInPandas(partial, shape).groupBy("i").applyInPandas(added, shape)
    found = np.array([r.row for r in sums.orderBy("i").collect()])
    return found[:, :-1], found[:, -1]


def fit(labelled: DataFrame, waves: int = 256, ridge: float = 1.0, bins: int = 1000, seed: int = 5) -> Model | None:
    """A model of rows (stats, label, calibrate); rows marked calibrate are only used to calibrate."""
    width = len(STATISTICS)
    at = [F.col("stats")[i] for i in range(width)]
    moments = labelled.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(at)],
        *[F.count(F.when(F.col("calibrate") == b, 1)).alias(f"c{int(b)}") for b in (True, False)],
    ).first()
    if not moments.c0:
        return None
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    scale = np.array([moments[f"s{i}"] for i in range(width)])
    rng = np.random.default_rng(seed)
    model = Model(
        mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 1 / np.sqrt(width), (width, waves)),
        rng.uniform(0, 2 * np.pi, waves), np.zeros(0), np.array([0.0, 1.0]), np.array([0.0, 1.0]),
    )
    xx, xy = normal_equations(labelled.where("NOT calibrate"), model)
    penalty = ridge * np.eye(len(xx))
    penalty[-1, -1] = 1e-6
    model = Model(**{**model.__dict__, "weights": np.linalg.solve(xx + penalty, xy)})
    if not moments.c1:
        return model

    def raw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            score = model.raw(matrix(frame["stats"]))
            yield pd.DataFrame({"bin": np.clip(np.round((score + 1) * bins / 3), 0, bins).astype(np.int64), "label": frame["label"].astype(float)})

    held = labelled.where("calibrate").select("stats", "label").mapInPandas(raw, "bin bigint, label double")
    table = held.groupBy("bin").agg(F.avg("label").alias("y"), F.count("*").alias("w")).orderBy("bin").toPandas()
    levels = isotonic(table["y"].to_numpy(), table["w"].to_numpy())
    steps = table["bin"].to_numpy() * 3 / bins - 1
    # A slight slope keeps the order of raw scores inside a level.
    levels = 0.98 * levels + 0.02 * (steps + 1) / 3
    return Model(**{**model.__dict__, "steps": steps, "levels": levels})


def held_out(key: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; learns from the other folds only."""
    stats = fixed(document_statistics(docs), "statistics")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    labelled = stats.join(known.where("label IS NOT NULL AND doc_id IS NOT NULL"), "doc_id").where(~held_out(F.col("doc_id")))
    model = fit(fixed(labelled.select("stats", "label", (fold == 1).alias("calibrate")), "labelled"))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = model.score(matrix(frame["stats"])) if model else np.full(len(frame), 0.5)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": values})

    result = stats.mapInPandas(scored, "doc_id bigint, score double")
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
