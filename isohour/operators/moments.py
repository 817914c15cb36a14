"""Least squares from mergeable moment matrices: one scan sums, any union of blocks is solved without another."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from isohour.operators.forecast import Linear
from isohour.session import workers_import


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred products of the features and, last, the target."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Moments:
        mean = values.mean(axis=0)
        centred = values - mean
        return cls(len(values), mean, centred.T @ centred)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)

    def solved(self, names: Sequence[str]) -> Linear:
        """Linear regression on features scaled to unit deviation; a feature that does not vary has no weight."""
        spread = np.sqrt(np.diag(self.products)[:-1])
        used = spread > 1e-12 * (1 + np.abs(self.mean[:-1]) * np.sqrt(self.n))
        scale = spread[used]
        left = self.products[:-1, :-1][np.ix_(used, used)] / np.outer(scale, scale)
        weights = np.zeros(len(names))
        weights[used] = np.linalg.lstsq(left, self.products[:-1, -1][used] / scale, rcond=1e-10)[0] / scale
        return Linear(dict(zip(names, weights.tolist())), float(self.mean[-1] - weights @ self.mean[:-1]))


def block_moments(rows: DataFrame, columns: Sequence[str], target: str, block: str = "block") -> dict[int, Moments]:
    """The moments of each block. Every task sums its own rows, one task per block merges those sums, and one small
    matrix per block reaches the driver. Rows with a missing value are left out."""
    workers_import(rows.sparkSession)
    names = [*columns, target]
    shape = "block int, n bigint, mean array<double>, products array<double>"

    def as_batch(found: dict[int, Moments]) -> pa.RecordBatch:
        made = [{"block": b, "n": m.n, "mean": m.mean.tolist(), "products": m.products.ravel().tolist()} for b, m in found.items()]
        types = pa.schema([("block", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])
        return pa.RecordBatch.from_pylist(made, types)

    def gathered(parts: Iterable[tuple[int, Moments]]) -> dict[int, Moments]:
        found: dict[int, Moments] = {}
        for number, part in parts:
            found[number] = found[number].merged(part) if number in found else part
        return found

    def parts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, Moments]]:
        numbers = batch.column(0).to_numpy()
        values = np.stack([batch.column(k + 1).to_numpy(zero_copy_only=False) for k in range(len(names))], axis=1)
        for number in np.unique(numbers).tolist():
            yield number, Moments.of(values[numbers == number])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield as_batch(gathered(part for batch in batches if batch.num_rows for part in parts_of(batch)))

    def read(batch: pa.RecordBatch) -> Iterator[tuple[int, Moments]]:
        for row in batch.to_pylist():
            yield row["block"], Moments(row["n"], np.array(row["mean"]), np.array(row["products"]).reshape(len(names), -1))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield as_batch(gathered(part for batch in batches for part in read(batch)))

    values = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]
    plain = rows.select(F.col(block).cast("int").alias("block"), *values).dropna()
    partial = plain.mapInArrow(summed, shape).repartition("block").mapInArrow(merged, shape)
    return dict(part for batch in partial.toArrow().to_batches() for part in read(batch))


def expanding_fits(blocks: dict[int, Moments], names: Sequence[str], folds: int) -> dict[int, Linear]:
    """The regression of each fold on all blocks before it, from running sums of the blocks' moments."""
    fits: dict[int, Linear] = {}
    so_far: Moments | None = None
    for fold in range(1, folds + 1):
        part = blocks.get(fold - 1)
        if part is not None:
            so_far = part if so_far is None else so_far.merged(part)
        if so_far is not None:
            fits[fold] = so_far.solved(names)
    return fits
