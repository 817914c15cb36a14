"""Boosted trees and moment matrices against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohour.operators import boosting, moments
from isohour.operators.boosting import Fit, Settings


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    made = []
    for i in range(240):
        a, b, c = rng.randrange(12), rng.randrange(5), rng.choice([None, 0.0, 1.5])
        y = 3.0 * (a > 5) - 2.0 * b * (a > 8) + (c or 0) + rng.randrange(3)
        made.append((i, float(a), float(b), c, 7.0, y if i % 17 else None, float(y > 1), i // 40))
    return spark.createDataFrame(made, "id long, a double, b double, c double, flat double, y double, wet double, block int").repartition(3).persist()


COLUMNS = ["a", "b", "c", "flat"]


def grown(data, label, settings, before):
    """Every threshold of every feature tried at every node, on plain lists."""
    used = [r for r in data if r[label] is not None and (before is None or r["block"] < before)]
    mean = sum(r[label] for r in used) / len(used)
    start = math.log(mean / (1 - mean)) if settings.logistic else mean
    score = {r["id"]: start for r in data}

    def value(r, c):
        return -math.inf if r[c] is None else r[c]

    def fitted(members, depth):
        def terms(some):
            if settings.logistic:
                chances = [1 / (1 + math.exp(-score[r["id"]])) for r in some]
                return sum(r[label] - p for r, p in zip(some, chances)), sum(p * (1 - p) for p in chances)
            return sum(r[label] - score[r["id"]] for r in some), float(len(some))

        g, h = terms(members)
        best = None
        if depth < settings.depth:
            for c in COLUMNS:
                for t in sorted({r[c] for r in data if r[c] is not None})[:-1]:
                    left = [r for r in members if value(r, c) <= t]
                    right = [r for r in members if value(r, c) > t]
                    if min(len(left), len(right)) < settings.least_rows:
                        continue
                    (gl, hl), (gr, hr) = terms(left), terms(right)
                    gain = gl * gl / hl + gr * gr / hr - g * g / h
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, c, t, left, right
        if best is None:
            return (lambda r: g / h) if depth else (lambda r: 0.0)
        _, c, t, left, right = best
        low, high = fitted(left, depth + 1), fitted(right, depth + 1)
        return lambda r: low(r) if value(r, c) <= t else high(r)

    for _ in range(settings.rounds):
        tree = fitted(used, 0)
        step = {r["id"]: settings.rate * tree(r) for r in data}
        score = {k: s + step[k] for k, s in score.items()}
    return {k: 1 / (1 + math.exp(-s)) if settings.logistic else s for k, s in score.items()}


FITS = [
    Fit("squares", "y", Settings(rounds=3, rate=0.5, depth=3)),
    Fit("early", "y", Settings(rounds=4, rate=0.3, depth=2, least_rows=15), 3),
    Fit("chance", "wet", Settings(rounds=3, rate=0.4, depth=2, logistic=True)),
]


@pytest.mark.parametrize("broadcast_bytes", [boosting.BROADCAST_BYTES, 0])
def test_ensembles_equal_brute_force(rows, monkeypatch, broadcast_bytes):
    """On a broadcast copy and level by level, with predictions stored every second round."""
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2)
    made = boosting.fit_all(rows, COLUMNS, FITS, ["id"], broadcast_bytes=broadcast_bytes)
    data = [r.asDict() for r in rows.collect()]
    for fit, model in zip(FITS, made):
        want = grown(data, fit.label, fit.settings, fit.before)
        both = model.predict(rows, "p").withColumn("e", model.on({c: F.col(c) for c in COLUMNS}))
        for r in both.collect():
            assert r.p == pytest.approx(want[r.id], abs=1e-9) and r.e == pytest.approx(r.p, abs=1e-12)
        assert len(model.trees) == fit.settings.rounds and model.importances()[-1] == ("flat", 0.0)


def test_both_ways_draw_the_same_samples(rows, monkeypatch):
    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2)
    fits = [Fit("s", "y", Settings(rounds=5, rate=0.3, depth=3, row_share=0.6, feature_share=0.5, seed=7), k) for k in (2, 4)]
    near, far = (boosting.fit_all(rows, COLUMNS, fits, ["id"], broadcast_bytes=b) for b in (1 << 20, 0))
    for a, b in zip(near, far):
        for x, y in zip(a.trees, b.trees):
            assert (x.feature == y.feature).all() and (x.bin == y.bin).all() and np.allclose(x.value, y.value)
    assert boosting.Ensemble.loaded(near[0].saved()).table() == near[0].table()


def test_nothing_to_fit(rows):
    for b in (1 << 20, 0):
        (model,) = boosting.fit_all(rows.limit(0), COLUMNS, [Fit("x", "y", Settings(rounds=2, depth=2))], ["id"], broadcast_bytes=b)
        assert {r.p for r in model.predict(rows, "p").collect()} == {0.0}


def test_moments_solve_every_fold(rows):
    columns = ["a", "b", "flat"]
    blocks = moments.block_moments(rows, columns, "y")
    fits = moments.expanding_fits(blocks, columns, 5)
    data = [r for r in rows.collect() if r.y is not None]
    assert sorted(blocks) == list(range(6)) and sum(m.n for m in blocks.values()) == len(data)
    for fold, model in fits.items():
        train = [r for r in data if r.block < fold]
        design = np.array([[1, r.a, r.b] for r in train])
        want = np.linalg.lstsq(design, np.array([r.y for r in train]), rcond=None)[0]
        assert [model.intercept, model.weights["a"], model.weights["b"]] == pytest.approx(want.tolist())
        assert model.weights["flat"] == 0.0


def test_scores_of_folds(rows):
    (model,) = boosting.fit_all(rows, COLUMNS, [FITS[0]], ["id"])
    found = boosting.scores_of_folds(rows.withColumnRenamed("y", "label"), [("m", 2, model), ("m", 4, model)], COLUMNS)
    want = model.predict(rows.where("block IN (2, 4)"), "p")
    key = lambda r: tuple(-1e9 if v is None else v for v in r)
    assert sorted(map(tuple, found.select("fold", "label", "prediction").collect()), key=key) == sorted(
        map(tuple, want.select("block", "y", "p").collect()), key=key
    )
