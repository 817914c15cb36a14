from __future__ import annotations

import random
from datetime import timedelta

import pytest
from helpers import at, rows_of
from pyspark.sql import functions as F

from isohour.functions.times import month_key, plus_hours
from isohour.operators import features as ft
from isohour.operators import forecast as fc
from isohour.operators.running import running_totals, tail_rows


def gappy(spark, cities=3, hours=900, keep=0.7, seed=1):
    """Series with gaps, NULLs and one short series."""
    rng = random.Random(seed)
    rows = []
    for city in range(cities):
        for h in range(hours if city else 40):
            if rng.random() < keep:
                t = None if rng.random() < 0.05 else round(rng.uniform(-5, 35), 1)
                hour = h if h < 500 else 9 * h
                rows.append((city, at(hour), t, float(h % 90), 1000.0 + h % 13, h % 4 / 2))
    kind = (
        "city_id int, timestamp timestamp_ntz, temperature double, humidity double, "
        "pressure double, precipitation double"
    )
    return spark.createDataFrame(rows, kind)


def by_hand(rows):
    """The features in plain pandas, city by city."""
    import pandas as pd

    parts = []
    for _, one in rows.sort_values("timestamp").groupby("city_id"):
        one = one.copy()
        for t in ft.PRODUCTION.trails:
            for n in t.lags:
                one[f"{t.prefix}lag_{n}h"] = one[t.measure].shift(n)
            for n in t.means:
                one[f"{t.prefix}roll_{n}h"] = (
                    one[t.measure].shift(1).rolling(n, min_periods=1).mean()
                )
        parts.append(one)
    return pd.concat(parts)


@pytest.mark.parametrize(
    "chunk_rows, scale", [(None, None), (168, None), (168, 1), (200, 1), (8192, None), (None, 1)]
)
def test_trails_equal_pandas_for_any_chunking(spark, chunk_rows, scale):
    import pandas as pd

    df = gappy(spark)
    made = ft.with_trails(
        df, ft.PRODUCTION.trails, chunk_rows=chunk_rows, scale=scale
    ).toPandas()
    hand = by_hand(df.toPandas())
    order = ["city_id", "timestamp"]
    columns = order + ft.PRODUCTION.trailing()
    pd.testing.assert_frame_equal(
        made.sort_values(order)[columns].reset_index(drop=True),
        hand.sort_values(order)[columns].reset_index(drop=True),
        check_dtype=False,
    )


def test_chunks_smaller_than_the_reach_are_refused(spark):
    from isohour.operators.running import over_trailing_rows

    with pytest.raises(ValueError):
        over_trailing_rows(gappy(spark), dict, 168, "timestamp", F.lit(0), ["city_id"], 100)


def test_a_long_series_is_spread_over_chunks(spark):
    """No task of the window stage gets more than a chunk and its reach."""
    df = gappy(spark, cities=2, hours=900, keep=1.0)
    window_rows = ft.with_trails(df, ft.PRODUCTION.trails, chunk_rows=168)
    text = window_rows._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in text and window_rows.count() == df.count()


def test_series_are_always_cut(spark):
    df = gappy(spark, cities=2)
    cut = ft.with_trails(df, (ft.HUMIDITY,))
    assert "_chunk" in cut._jdf.queryExecution().toString()
    short = ft.with_trails(df, (ft.HUMIDITY,), chunk_rows=100)
    assert rows_of(cut, *cut.columns) == rows_of(short, *cut.columns)


def test_rows_of_an_unknown_series_are_dropped(spark):
    df = gappy(spark).withColumn("city_id", F.when(F.col("city_id") != 1, F.col("city_id")))
    for chunk_rows in (None, 8192):
        kept = ft.with_trails(df, (ft.HUMIDITY,), chunk_rows=chunk_rows)
        assert kept.where("city_id IS NULL").count() == 0
        assert kept.count() == df.where("city_id IS NOT NULL").count()


def test_feature_lists(spark):
    assert len(ft.EXPERIMENT.columns()) == 23 and len(ft.PRODUCTION.columns()) == 25
    assert "city_id" in ft.EXPERIMENT.columns() and "precip_lag_1h" not in ft.EXPERIMENT.columns()
    assert ft.PRODUCTION.reach() == 168


def test_feature_table_is_complete(spark):
    df = gappy(spark).withColumn("latitude", F.lit(1.0)).withColumn("longitude", F.lit(2.0))
    table = ft.feature_table(df, ft.PRODUCTION)
    assert set(ft.PRODUCTION.columns()) <= set(table.columns)
    assert table.count() > 0
    some_null = " OR ".join(f"{c} IS NULL" for c in ft.PRODUCTION.trailing())
    assert table.where(some_null).count() == 0
    assert table.where("city_id = 0").count() == 0
    with pytest.raises(ValueError):
        ft.feature_table(df, ft.PRODUCTION, mode="other")


def test_features_do_not_see_the_future(spark):
    df = gappy(spark)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    changed = df.withColumn(
        "temperature", F.when(F.col("timestamp") >= cut, 99.0).otherwise(F.col("temperature"))
    )
    before = F.col("timestamp") <= cut
    columns = ["city_id", "timestamp", *ft.PRODUCTION.trailing()]
    one, two = (
        ft.with_trails(d, ft.PRODUCTION.trails).where(before).select(columns) for d in (df, changed)
    )
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_clock_mode_leaves_gaps_missing(spark):
    rows = [(1, at(0), 1.0), (1, at(1), 2.0), (1, at(3), 4.0), (1, at(24 * 40), 5.0)]
    df = spark.createDataFrame(rows, "city_id int, timestamp timestamp_ntz, temperature double")
    only = ft.FeatureSet((ft.Trail("temperature", "", (1, 2), ()),), ())
    by_row = ft.feature_table(df, only, complete_only=False)
    by_clock = ft.feature_table(df, only, mode="clock", complete_only=False)
    assert rows_of(by_row, "temperature", "lag_1h") == [(1.0, None), (2.0, 1.0), (4.0, 2.0), (5.0, 4.0)]
    assert rows_of(by_clock, "temperature", "lag_1h", "lag_2h") == [
        (1.0, None, None),
        (2.0, 1.0, None),
        (4.0, None, 2.0),
        (5.0, None, None),
    ]


@pytest.mark.parametrize("scale", [None, 1])
@pytest.mark.parametrize("chunk_hours", [None, 3])
def test_clock_mode_keeps_rows_at_any_minute(spark, scale, chunk_hours):
    """Half-hour rows over the end of a month, other minutes, seconds, and rows without a place."""
    half = [(1, at(24 * 30 + 21.5 + k / 2), float(k)) for k in range(10)]
    odd = [(2, at(24 * 30 + h), round(10 * h, 1)) for h in (0.25, 1.25, 1.2505, 3.25, 4.25, 700.25)]
    none = [(None, at(1), 1.0), (None, at(2), 2.0), (3, None, 3.0), (3, None, 4.0)]
    df = spark.createDataFrame(half + odd + none, "city_id int, timestamp timestamp_ntz, temperature double")
    only = ft.FeatureSet((ft.Trail("temperature", "", (1, 2), (2,)),), ())
    found = ft.feature_table(df, only, mode="clock", complete_only=False, scale=scale, chunk_rows=chunk_hours)
    want = [(*r, None, None, None) for r in none]
    for city, stamp, t in half + odd:
        own = {s: v for c, s, v in half + odd if c == city}
        before = [v for s, v in own.items() if stamp - timedelta(hours=2) <= s < stamp]
        lags = [own.get(stamp - timedelta(hours=n)) for n in (1, 2)]
        want.append((city, stamp, t, *lags, sum(before) / len(before) if before else None))
    assert found.count() == 20
    for a, b in zip(rows_of(found, "city_id", "timestamp", "temperature", "lag_1h", "lag_2h", "roll_2h"), sorted(want, key=repr)):
        assert a[:5] == b[:5] and a[5] == (b[5] if b[5] is None else pytest.approx(b[5])), (a, b)


def test_running_totals(spark):
    df = spark.createDataFrame([("a", i, i % 3) for i in range(50)] + [("b", 1, 5)], "g string, i int, v int")
    found = running_totals(df, {"before": F.col("v")}, ["i"], F.floor(F.col("i") / 7), ["g"], totals=True)
    want = [("a", i, sum(j % 3 for j in range(i)), sum(j % 3 for j in range(50))) for i in range(50)]
    assert rows_of(found, "g", "i", "before", "before_total") == sorted(want + [("b", 1, 0, 5)], key=repr)


def test_tail_rows(spark):
    df = gappy(spark)
    tail = tail_rows(df, 25, "timestamp", month_key(F.col("timestamp")), ["city_id"])
    pdf = df.toPandas().sort_values("timestamp").groupby("city_id").tail(25)
    assert rows_of(tail, "city_id", "timestamp") == sorted(
        ((r.city_id, r.timestamp.to_pydatetime()) for r in pdf.itertuples()), key=repr
    )


def test_serving_features_equal_training_features(spark):
    """The first forecast hour sees what training would see in the row after the last one."""
    df = gappy(spark, keep=0.95)
    nexts = df.groupBy("city_id").agg(F.max("timestamp").alias("last_ts")).select(
        "city_id",
        plus_hours(F.col("last_ts"), F.lit(1)).alias("timestamp"),
        *[F.lit(None).cast("double").alias(c) for c in fc.STATE],
    )
    trained = ft.with_calendar(
        ft.with_trails(df.unionByName(nexts), ft.PRODUCTION.trails).join(
            nexts.select("city_id", "timestamp"), ["city_id", "timestamp"]
        )
    )
    state = fc.buffers(df, "city_id")
    known = fc.next_hour_features(
        {m: F.col(m) for m in fc.STATE},
        ft.PRODUCTION.trails,
        plus_hours(F.col("last_ts"), F.lit(1)),
    )
    served = state.select("city_id", *[c.alias(n) for n, c in known.items()])
    names = [*ft.PRODUCTION.trailing(), *ft.CALENDAR]
    a = {r.city_id: r for r in trained.collect()}
    b = {r.city_id: r for r in served.collect()}
    assert set(a) == set(b) == {0, 1, 2}
    for city in a:
        for n in names:
            assert (a[city][n] is None) == (b[city][n] is None), n
            if a[city][n] is not None:
                assert a[city][n] == pytest.approx(b[city][n]), n
