"""Boosted regression trees from binned histograms, several fits at once.

Features are binned once to bytes by table-wide quantiles. Where the binned table is at most ``BROADCAST_BYTES``, which is
counted, it is broadcast and every fit is one task. Beyond that size rows stay where they are, and a level of a tree is one pass for all fits (folds,
candidates) together: every task sums gradients per fit, node, feature and bin, sums of one (fit, node) meet in one
task, which chooses the split and its children's values, and only those reach the driver. Rows never move: the pass recomputes their
predictions from the stored ones and the trees since, and every ``STORED_ROUNDS`` rounds predictions are stored anew in the
shared folder, so that a lost executor costs a bounded recomputation.

What is shuffled per level is (tasks x fits x nodes) histograms of features x bins, whatever the number of rows.

Trees are complete binary heaps: the children of node k are 2k + 1 (value <= threshold) and 2k + 2. A missing value goes
to the first child. Sampled rows and features are drawn by hash, so fits can be repeated.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from isohour.session import materialise, workers_import

STORED_ROUNDS = 10
BROADCAST_BYTES = 64 << 20
LEAST_GAIN = 1e-9
SPLIT = "fit int, node int, feature int, bin int, gain double, left_value double, right_value double"
SPLIT_NAMES = [c.split()[0] for c in SPLIT.split(", ")]
SPLIT_TYPES = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.float64()) for c in SPLIT.split(", ")])


@dataclass(frozen=True)
class Settings:
    """How one ensemble is fitted. ``logistic`` fits log-odds of a 0/1 label."""

    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    row_share: float = 1.0
    feature_share: float = 1.0
    least_rows: int = 1
    logistic: bool = False
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One ensemble to fit: on rows whose block is below ``before`` and whose label is known."""

    name: str
    label: str
    settings: Settings = Settings()
    before: int | None = None


@dataclass
class Tree:
    """A complete heap. ``feature`` is -1 where a node is a leaf or unused."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))

    def nodes(self, binned: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row has reached after ``depth`` steps."""
        at = np.zeros(len(binned), np.int64)
        rows = np.arange(len(binned))
        for _ in range(depth):
            feature = self.feature[at]
            inner = feature >= 0
            right = binned[rows, np.maximum(feature, 0)] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


@dataclass
class Ensemble:
    """A fitted ensemble over ``columns``; ``on`` makes it a column expression."""

    columns: list[str]
    edges: list[list[float]]
    start: float
    settings: Settings
    trees: list[Tree] = field(default_factory=list)
    gains: np.ndarray | None = None

    @property
    def names(self) -> list[str]:
        """The features that the ensemble reads."""
        return self.columns

    def table(self) -> list[tuple[int, int, int, float | None, float]]:
        """(tree, node, feature, threshold, value) of every node, unused ones without a feature and with value 0."""
        return [
            (t, k, int(f), self.edges[f][int(b)] if f >= 0 else None, float(v))
            for t, tree in enumerate(self.trees)
            for k, (f, b, v) in enumerate(zip(tree.feature, tree.bin, tree.value))
        ]

    def on(self, features: Mapping[str, Column]) -> Column:
        """The prediction as one expression: every tree is walked by look-ups in constant arrays. The features are bound
        once, so that look-ups do not work them out again."""
        nodes = self.table()
        size, depth = 2 ** (self.settings.depth + 1) - 1, self.settings.depth
        feature = constant([f for _, _, f, _, _ in nodes], "int")
        threshold = constant([0.0 if t is None else t for _, _, _, t, _ in nodes], "double")
        value = constant([v for *_, v in nodes], "double")

        def step(row: Column, at: Column, base: Column) -> Column:
            here = F.get(feature, at)
            right = F.coalesce(F.get(row, here) > F.get(threshold, at), F.lit(False))
            return F.when(here < 0, at).otherwise(2 * at - base + 1 + right.cast("int"))

        def add(row: Column, total: Column, tree: Column) -> Column:
            base = tree * size
            leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), base, lambda at, _: step(row, at, base))
            return total + F.lit(self.settings.rate) * F.get(value, leaf)

        def score(row: Column) -> Column:
            trees = F.sequence(F.lit(0), F.lit(len(self.trees) - 1))
            return F.aggregate(trees, F.lit(float(self.start)), lambda total, tree: add(row, total, tree))

        row = F.array(*[features[c].cast("double") for c in self.columns])
        total = F.get(F.transform(F.array(row), score), F.lit(0)) if self.trees else F.lit(float(self.start))
        return 1.0 / (1.0 + F.exp(-total)) if self.settings.logistic else total

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """The prediction of every row of binned features."""
        total = np.full(len(codes), float(self.start))
        for tree in self.trees:
            total += self.settings.rate * tree.value[tree.nodes(codes, self.settings.depth)]
        return 1 / (1 + np.exp(-total)) if self.settings.logistic else total

    def predict(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with the prediction as a column, worked out batch by batch."""
        workers_import(rows.sparkSession)

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = self.scores(codes_of(matrix(batch, "_values", np.float64), self.edges))
                yield batch.drop_columns(["_values"]).append_column(name, pa.array(made))

        return rows.withColumn("_values", values_of(self.columns)).mapInArrow(scored, StructType([*rows.schema.fields, StructField(name, DoubleType())]))

    def saved(self) -> dict:
        """Everything as plain values, for a row of JSON."""
        return {
            "columns": self.columns, "edges": self.edges, "start": self.start, "settings": asdict(self.settings),
            "trees": [{k: getattr(t, k).tolist() for k in ("feature", "bin", "value")} for t in self.trees],
            "gains": None if self.gains is None else self.gains.tolist(),
        }

    @classmethod
    def loaded(cls, found: dict) -> Ensemble:
        trees = [Tree(np.array(t["feature"], np.int32), np.array(t["bin"], np.int32), np.array(t["value"])) for t in found["trees"]]
        gains = None if found["gains"] is None else np.array(found["gains"])
        return cls(found["columns"], found["edges"], found["start"], Settings(**found["settings"]), trees, gains)

    def importances(self) -> list[tuple[str, float]]:
        """Shares of the gain, greatest first."""
        whole = self.gains.sum() or 1.0
        return sorted(zip(self.columns, (self.gains / whole).tolist()), key=lambda x: (-x[1], x[0]))


def constant(values: Sequence, kind: str) -> Column:
    """A long constant array: its text is folded once, not one expression a value."""
    return F.from_json(F.lit("[" + ",".join(map(repr, values)) + "]"), f"array<{kind}>")


def bin_edges(rows: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """Rising thresholds of each feature: its distinct ``bins``-quantiles but the greatest, in one mergeable aggregate."""
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(q or ())) for q in found]


def values_of(columns: Sequence[str]) -> Column:
    """The features as one array; a missing value is NaN."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns])


def codes_of(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """The bin of every value: how many thresholds are below it. A missing value is in the first bin."""
    made = np.zeros(values.shape, np.int64)
    for k, thresholds in enumerate(edges):
        made[:, k] = np.searchsorted(np.array(thresholds), values[:, k], side="left")
    made[np.isnan(values)] = 0
    return made


def binned(rows: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]], fits: Sequence[Fit], keys: Sequence[str]) -> DataFrame:
    """One row of bytes, labels and a number to sample by per row."""
    labels = dict.fromkeys(fit.label for fit in fits)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(matrix(batch, "values", np.float64), edges).astype(np.int8)
                borders = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * codes.shape[1])
                column = pa.ListArray.from_arrays(borders, pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([column, *batch.columns[1:]], ["bins", "labels", "block", "draw"])

    plain = rows.select(
        values_of(columns).alias("values"),
        F.array(*[F.col(label).cast("double") for label in labels]).alias("labels"),
        (F.col("block") if "block" in rows.columns else F.lit(0)).cast("int").alias("block"),
        F.xxhash64(*keys).alias("draw"),
    )
    return plain.mapInArrow(coded, "bins array<tinyint>, labels array<double>, block int, draw bigint")


def scores_of_folds(rows: DataFrame, models: Sequence[tuple[str, int, Ensemble]], columns: Sequence[str], label: str = "label") -> DataFrame:
    """(model, fold, label, prediction) of the rows whose ``block`` is a model's fold, for all models in one scan."""
    workers_import(rows.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, values = batch.column(0).to_numpy(), matrix(batch, "values", np.float64)
            for name, fold, model in models:
                mine = np.flatnonzero(block == fold)
                if len(mine):
                    made = model.scores(codes_of(values[mine], model.edges))
                    columns = [pa.array([name] * len(mine)), pa.array(block[mine]), batch.column(1).take(pa.array(mine)), pa.array(made)]
                    yield pa.RecordBatch.from_arrays(columns, ["model", "fold", "label", "prediction"])

    plain = rows.where("block IS NOT NULL").select(F.col("block").cast("int"), F.col(label).cast("double").alias("label"), values_of(columns).alias("values"))
    return plain.mapInArrow(scored, "model string, fold int, label double, prediction double")


class Growth:
    """What a pass needs to know: all fits, their trees since predictions were stored, and the trees that grow."""

    def __init__(self, fits: Sequence[Fit], width: int, bins: int) -> None:
        labels = list(dict.fromkeys(fit.label for fit in fits))
        self.fits = [(labels.index(f.label), f.before, f.settings) for f in fits]
        self.width, self.bins = width, bins
        self.starts = [0.0] * len(fits)
        self.since: list[list[Tree]] = [[] for _ in fits]
        self.growing: list[Tree | None] = [None] * len(fits)
        self.round = self.level = 0

    def scores(self, fit: int, codes: np.ndarray, stored: np.ndarray) -> np.ndarray:
        settings = self.fits[fit][2]
        total = stored.copy()
        for tree in self.since[fit]:
            total += settings.rate * tree.value[tree.nodes(codes, settings.depth)]
        return total

    def drawn(self, fit: int, draw: np.ndarray) -> np.ndarray:
        """The rows that a round sees."""
        settings = self.fits[fit][2]
        if settings.row_share >= 1:
            return np.ones(len(draw), bool)
        mixed = draw.view(np.uint64) ^ np.uint64((settings.seed * 1_000_003 + self.round) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53 < settings.row_share

    def histograms(self, codes: np.ndarray, labels: np.ndarray, block: np.ndarray, draw: np.ndarray, stored: np.ndarray) -> Iterator:
        """(fit, node) and its sums by feature and bin: residuals, counts and, where they differ, weights."""
        shape = -1, self.width, self.bins
        spread = codes + np.arange(self.width) * self.bins
        first = 2**self.level - 1
        for fit, (label, before, settings) in enumerate(self.fits):
            tree = self.growing[fit]
            if tree is None:
                continue
            target = labels[:, label]
            used = ~np.isnan(target) & self.drawn(fit, draw)
            if before is not None:
                used &= block < before
            node = tree.nodes(codes, self.level) - first
            at = np.flatnonzero(used & (node >= 0))
            score = self.scores(fit, codes[at], stored[at, fit])
            if settings.logistic:
                chance = 1 / (1 + np.exp(-score))
                values = [target[at] - chance, None, chance * (1 - chance)]
            else:
                values = [target[at] - score, None]
            met, rank = np.unique(node[at], return_inverse=True)
            flat = (spread[at] + (rank * self.width * self.bins)[:, None]).ravel()
            size = len(met) * self.width * self.bins
            sums = [np.bincount(flat, None if v is None else np.repeat(v, self.width), size).reshape(shape) for v in values]
            for k, number in enumerate(met.tolist()):
                yield (fit, first + number), np.stack([s[k] for s in sums]).astype(np.float64)


def plain_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Bins, labels, block and draw of a batch as numpy arrays."""
    return matrix(batch, "bins", np.int64), matrix(batch, "labels", np.float64), batch.column("block").fill_null(-1).to_numpy(), batch.column("draw").to_numpy()


def matrix(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """A column of equally long arrays."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)


def arrays_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The same with the stored scores."""
    return *plain_arrays(batch), matrix(batch, "scores", np.float64)


def chosen_split(sums: np.ndarray, allowed: np.ndarray, least: float) -> tuple:
    """Feature, bin, gain and both children's values of the best split of one node's histograms, the first of equals;
    feature -1 where none gains."""
    bins = sums.shape[2]
    whole = sums[:, 0, :].sum(axis=1)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = whole[:, None, None] - left
    # the last row holds the weights, which are the counts for squared errors
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[-1] + right[0] ** 2 / right[-1] - whole[0] ** 2 / whole[-1]
    gain[~((left[1] >= least) & (right[1] >= least)) | ~np.isfinite(gain) | ~allowed[:, None]] = -np.inf
    best = int(np.argmax(gain)) if gain.size else 0
    if not gain.size or not gain.flat[best] > LEAST_GAIN:
        return -1, 0, 0.0, 0.0, 0.0
    feature, at = divmod(best, bins - 1)
    values = [float(side[0, feature, at] / side[-1, feature, at]) for side in (left, right)]
    return feature, at, float(gain.flat[best]), *values


def level_splits(rows: DataFrame, growth: Growth, allowed: list[np.ndarray]) -> list:
    """The split of every open node of the present level of all growing trees."""
    width, bins = growth.width, growth.bins

    def gathered(parts: Iterator[tuple[tuple[int, int], np.ndarray]]) -> dict[tuple[int, int], np.ndarray]:
        whole: dict[tuple[int, int], np.ndarray] = {}
        for key, sums in parts:
            whole[key] = whole[key] + sums if key in whole else sums
        return whole

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches if batch.num_rows for part in growth.histograms(*arrays_of(batch)))
        whole = gathered(parts)
        fits, nodes = zip(*whole) if whole else ((), ())
        raw = [sums.tobytes() for sums in whole.values()]
        yield pa.RecordBatch.from_arrays([pa.array(fits, pa.int32()), pa.array(nodes, pa.int32()), pa.array(raw, pa.binary())], ["fit", "node", "sums"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        whole = gathered(((fit, node), np.frombuffer(raw).reshape(-1, width, bins)) for fit, node, raw in rows_of)
        made = [(*key, *chosen_split(sums, allowed[key[0]], growth.fits[key[0]][2].least_rows)) for key, sums in whole.items()]
        if made:
            yield pa.RecordBatch.from_pylist([dict(zip(SPLIT_NAMES, m)) for m in made], SPLIT_TYPES)

    partial = rows.mapInArrow(summed, "fit int, node int, sums binary")
    tasks = min(len(growth.fits) << growth.level, rows.sparkSession.sparkContext.defaultParallelism)
    return [tuple(r) for r in partial.repartition(tasks, "fit", "node").mapInArrow(chosen, SPLIT).collect()]


def start_scores(rows: DataFrame, fits: Sequence[Fit]) -> list[float]:
    """The mean label of each fit's rows, or its log-odds."""
    labels = list(dict.fromkeys(fit.label for fit in fits))
    means = [
        F.avg(F.when(F.lit(True) if f.before is None else F.col("block") < f.before, F.col("labels")[labels.index(f.label)]))
        for f in fits
    ]
    found = rows.agg(*[m.alias(f"m{i}") for i, m in enumerate(means)]).first()
    made = []
    for fit, mean in zip(fits, found):
        mean = 0.0 if mean is None else mean
        share = min(max(mean, 1e-6), 1 - 1e-6)
        made.append(math.log(share / (1 - share)) if fit.settings.logistic else mean)
    return made


def stored_scores(rows: DataFrame, growth: Growth) -> DataFrame:
    """The rows with predictions that include the trees since the last store."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _, _, _, stored = arrays_of(batch)
            now = np.stack([growth.scores(f, codes, stored[:, f]) for f in range(len(growth.fits))], axis=1)
            borders = np.arange(batch.num_rows + 1, dtype=np.int32) * now.shape[1]
            column = pa.ListArray.from_arrays(pa.array(borders), pa.array(now.ravel()))
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", column)

    return rows.mapInArrow(scored, rows.schema)


class Growing:
    """Ensembles that grow together. ``splits_of`` finds the splits of a level, ``store`` takes over the trees of some rounds."""

    def __init__(self, growth: Growth, made: list[Ensemble]) -> None:
        self.growth, self.made = growth, made

    def grow(self, splits_of: Callable[[list[np.ndarray]], list], store: Callable[[], None]) -> None:
        growth, made = self.growth, self.made
        settings = [e.settings for e in made]
        for number in range(max((s.rounds for s in settings), default=0)):
            growth.round = number
            growth.growing = [Tree.empty(s.depth) if number < s.rounds else None for s in settings]
            allowed = [drawn_features(s, number, growth.width) for s in settings]
            for level in range(max(s.depth for s in settings)):
                growth.level = level
                splits = [s for s in splits_of(allowed) if s[2] >= 0 and level < settings[s[0]].depth]
                for fit, node, feature, at, gain, *values in splits:
                    tree = growth.growing[fit]
                    tree.feature[node], tree.bin[node] = feature, at
                    tree.value[2 * node + 1 : 2 * node + 3] = values
                    made[fit].gains[feature] += gain
                if not splits:
                    break
            for fit, tree in enumerate(growth.growing):
                if tree is not None:
                    growth.since[fit].append(tree)
                    made[fit].trees.append(tree)
            if (number + 1) % STORED_ROUNDS == 0:
                store()
                growth.since = [[] for _ in made]


def fit_level_by_level(plain: DataFrame, growing: Growing, starts: list[float]) -> list[Ensemble]:
    """All fits in lockstep over rows that stay where they are."""
    stored = [materialise(plain.withColumn("scores", F.array(*map(F.lit, starts))), "binned")]

    def store() -> None:
        stored[0] = materialise(stored_scores(stored[0], growing.growth), "scores")

    growing.grow(lambda allowed: level_splits(stored[0], growing.growth, allowed), store)
    return growing.made


def fit_side_by_side(plain: DataFrame, columns: list[str], edges: list, fits: Sequence[Fit], starts: list[float], bins: int) -> list[Ensemble]:
    """One fit a task over a broadcast copy of a table whose size was checked."""
    spark = plain.sparkSession
    batches = plain.toArrow().combine_chunks().to_batches()
    if not batches:
        return [Ensemble(columns, edges, s, f.settings, gains=np.zeros(len(columns))) for s, f in zip(starts, fits)]
    shared = spark.sparkContext.broadcast(plain_arrays(batches[0]))
    labels = list(dict.fromkeys(f.label for f in fits))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, targets, block, draw = shared.value
        for number in (n for b in batches for n in b.column(0).to_pylist()):
            fit = replace(fits[number], label="label")
            growth = Growth([fit], len(columns), bins)
            growing = Growing(growth, [Ensemble(columns, edges, starts[number], fit.settings, gains=np.zeros(len(columns)))])
            state = [codes, targets[:, [labels.index(fits[number].label)]], block, draw, np.full((len(codes), 1), starts[number])]

            def splits(allowed: list[np.ndarray]) -> list:
                return [(*key, *chosen_split(sums, allowed[0], fit.settings.least_rows)) for key, sums in growth.histograms(*state)]

            def store() -> None:
                state[4] = growth.scores(0, codes, state[4][:, 0])[:, None]

            growing.grow(splits, store)
            yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), "made": [json.dumps(growing.made[0].saved())]})

    tasks = spark.range(0, len(fits), 1, len(fits)).mapInArrow(fitted, "number bigint, made string")
    return [Ensemble.loaded(json.loads(r.made)) for r in sorted(tasks.collect())]


def fit_all(
    rows: DataFrame, columns: Sequence[str], fits: Sequence[Fit], keys: Sequence[str], bins: int = 32, broadcast_bytes: int = BROADCAST_BYTES
) -> list[Ensemble]:
    """All ensembles. ``rows`` hold the columns, the labels, for folds ``block``, and the ``keys`` that name a row for
    sampling. Both ways take the same splits from the same sums."""
    workers_import(rows.sparkSession)
    columns = list(columns)
    edges = bin_edges(rows, columns, bins)
    plain = binned(rows, columns, edges, fits, keys)
    starts = start_scores(plain, fits)
    labels = len({f.label for f in fits})
    if plain.count() * (8 * len(columns) + 8 * labels + 24) <= broadcast_bytes:
        return fit_side_by_side(plain, columns, edges, fits, starts, bins)
    made = [Ensemble(columns, edges, s, f.settings, gains=np.zeros(len(columns))) for s, f in zip(starts, fits)]
    return fit_level_by_level(plain, Growing(Growth(fits, len(columns), bins), made), starts)


def drawn_features(settings: Settings, number: int, width: int) -> np.ndarray:
    """The features that a round may split on."""
    allowed = np.zeros(width, bool)
    few = max(1, math.ceil(settings.feature_share * width))
    allowed[random.Random(settings.seed * 1_000_003 + number).sample(range(width), few)] = True
    return allowed
