from __future__ import annotations

import pytest
from helpers import at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.operators import checks, folds, metrics, profiles


def sample(spark):
    return raw(spark, [(0, 1, 1.0, 1), (0, 1, None, 2), (1, 1, 3.0, 1), (5, 2, 4.0, 1)])


def test_profiles(spark):
    df = sample(spark)
    assert rows_of(profiles.coverage(df), "city_id", "min_ts", "max_ts", "rows") == [
        (1, at(0), at(1), 3),
        (2, at(5), at(5), 1),
    ]
    assert rows_of(profiles.duplicate_hours(df), "city_id", "rows", "unique_hours") == [
        (1, 3, 2),
        (2, 1, 1),
    ]
    assert rows_of(profiles.null_profile(df), "city_id", "temp_nulls", "pressure_nulls") == [
        (1, 1, 0),
        (2, 0, 0),
    ]
    assert rows_of(profiles.sanity_ranges(df), "city_id", "min_temp", "max_temp") == [
        (1, 1.0, 3.0),
        (2, 4.0, 4.0),
    ]
    assert rows_of(profiles.duplicate_keys(df), "city_id", "cnt") == [(1, 2)]


def test_full_profile_equals_its_parts(spark):
    df = sample(spark)
    whole = profiles.full_profile(df)
    for part in (
        profiles.coverage(df),
        profiles.duplicate_hours(df),
        profiles.null_profile(df),
        profiles.sanity_ranges(df),
    ):
        assert rows_of(whole, *part.columns) == rows_of(part, *part.columns)


def test_extent(spark):
    assert profiles.extent(sample(spark)).first()[:] == (4, 2, at(0), at(5))
    assert profiles.extent(sample(spark).limit(0)).first()[:] == (0, 0, None, None)


def test_checks_count_failures(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (5, None)], "k int, v int")
    parent = spark.createDataFrame([(1,)], "k int")
    tables = {"t": df, "p": parent}
    rules = {
        "t": checks.Rules(("k", "v"), ("k", "v"), {"k": ("p", "k")}),
        "absent": checks.Rules(("x",)),
    }
    found = checks.run(tables, rules)
    assert rows_of(found, "column_name", "test", "failing_rows") == [
        ("k", "not_null", 1),
        ("k", "relationships", 1),
        ("k", "unique", 1),
        ("v", "not_null", 1),
        ("v", "unique", 0),
    ]


def test_checks_on_empty_tables(spark):
    empty = spark.createDataFrame([], "k int")
    rules = {"t": checks.Rules(("k",), ("k",), {"k": ("t", "k")})}
    assert {r.failing_rows for r in checks.run({"t": empty}, rules).collect()} == {0}


def test_warehouse_rules_count():
    rules = checks.WAREHOUSE_RULES.values()
    assert sum(len(r.not_null) for r in rules) == 33
    assert sum(len(r.unique) for r in rules) == 8
    assert sum(len(r.relationships or {}) for r in rules) == 7
    assert schemas.HOURLY_MART.names[-1] == "ingestion_ts"


def hours(spark, counts):
    rows = [(at(h), i) for h, n in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, i int")


def test_folds_follow_the_row_rule_where_hours_hold_one_row(spark):
    df = hours(spark, [1] * 29)
    blocks = {r.timestamp: r.block for r in folds.with_block(df).collect()}
    # 29 // 6 = 4: blocks of 4 rows, the first one takes the rest
    want = [0] * 9 + [1] * 4 + [2] * 4 + [3] * 4 + [4] * 4 + [5] * 4
    assert [blocks[at(h)] for h in range(29)] == want


def test_folds_never_split_an_hour_and_train_only_on_the_past(spark):
    blocked = folds.with_block(hours(spark, [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9] * 4))
    assert blocked.groupBy("timestamp").agg(F.count_distinct("block").alias("n")).where("n > 1").count() == 0
    for fold in range(1, 6):
        train, test = folds.split(blocked, fold)
        assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]
    summary = folds.fold_summary(blocked)
    assert summary.count() == 10
    by_rows = {(r.fold, r.part): r.rows for r in summary.collect()}
    for fold in range(1, 6):
        train, test = folds.split(blocked, fold)
        assert (train.count(), test.count()) == (by_rows[fold, "train"], by_rows[fold, "test"])


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0), (5.0, None)], "y double, p double")
    for scale in (None, 1):
        row = metrics.regression_metrics(df, "y", "p", scale=scale).first()
        assert (row.n, row.rmse, row.mae) == (2, pytest.approx(2.5**0.5), 1.5)


def test_auc_and_log_loss_against_brute_force(spark):
    import math
    import random

    rng = random.Random(3)
    rows = [(rng.randrange(2), round(rng.random(), 2)) for _ in range(400)]
    rows += [(1, 0.5)] * 200  # one score holds a third of all rows
    row = metrics.classification_metrics(
        spark.createDataFrame(rows, "y int, p double"), "y", "p"
    ).first()
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert row.auc == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
    clip = lambda p: min(max(p, 1e-15), 1 - 1e-15)
    loss = -sum(math.log(clip(p)) if y else math.log(1 - clip(p)) for y, p in rows) / len(rows)
    assert row.log_loss == pytest.approx(loss)
    assert (row.n, row.base_rate) == (600, len(pos) / 600)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert metrics.classification_metrics(df, "y", "p").first().auc is None


def test_leaderboard(spark):
    rows = [("a", 1, 3.0, 1.0, 1.0), ("a", 2, 1.0, 1.0, 1.0), ("b", 1, 1.0, 2.0, 1.0)]
    board = metrics.leaderboard(
        metrics.mean_over_folds(
            spark.createDataFrame(rows, "model string, fold int, rmse double, mae double, seconds double")
        )
    )
    assert [(r.model, r.rmse) for r in board.collect()] == [("b", 1.0), ("a", 2.0)]
    assert metrics.winner(board).first().model == "b"


def test_base_rate(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "rained int")
    assert metrics.base_rate(df).first()[:] == (4, 0.25)
