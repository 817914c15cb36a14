from __future__ import annotations

from datetime import date

import pytest
from helpers import at, raw, rows_of
from pyspark.sql import functions as F

from isohour import schemas
from isohour.functions.keys import compact_key, surrogate_key
from isohour.functions.measures import mean, rained, total
from isohour.functions.times import (
    backfill_range,
    calendar,
    day_of,
    days_before,
    hour_of,
    instant,
    month_key,
    since,
    version_label,
)
from isohour.operators import marts, upsert
from isohour.operators.dedup import keep_latest, staged, union_sources
from isohour.session import scratch_path

KEYS = ("city_id", "timestamp")


def places(spark):
    city = spark.createDataFrame(
        [(1, "A", 1.0, 2.0, 1), (2, "B", 3.0, 4.0, 9)], schemas.DIM_CITY
    )
    return city, spark.createDataFrame([(1, "X")], schemas.DIM_COUNTRY)


@pytest.mark.parametrize("form", ["rank", "aggregate"])
def test_keep_latest(spark, form):
    live = raw(spark, [(0, 1, 1.0, 1), (0, 1, 2.0, 2), (1, 1, 3.0, 1), (0, 2, 4.0, 1)])
    archive = raw(spark, [(0, 1, 9.0, 2), (1, 1, 8.0, 0), (0, None, 5.0, 1)])
    kept = keep_latest(union_sources(live, archive), KEYS, form=form)
    # the tie at load hour 2 goes to the greater row
    assert rows_of(kept, "city_id", "timestamp", "temperature") == [
        (1, at(0), 9.0),
        (1, at(1), 3.0),
        (2, at(0), 4.0),
        (None, at(0), 5.0),
    ]
    assert kept.columns == live.columns


def test_keep_latest_does_not_depend_on_row_order(spark):
    rows = [(h % 5, 1, float(h % 7), h % 3) for h in range(60)]
    one = keep_latest(raw(spark, rows), KEYS)
    two = keep_latest(raw(spark, rows[::-1]).repartition(3), KEYS, form="aggregate")
    assert rows_of(one, *one.columns) == rows_of(two, *one.columns)


def test_keep_latest_cuts_rows_before_the_shuffle(spark):
    plan = keep_latest(raw(spark, [(0, 1, 1.0, 1)]), KEYS)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "WindowGroupLimit" in text.split("Exchange")[1]


def test_unknown_form(spark):
    with pytest.raises(ValueError):
        keep_latest(raw(spark, []), KEYS, form="other")


def test_staged_key_is_unique_after_keep_latest(spark):
    rows = staged(keep_latest(raw(spark, [(0, 1, 1.0, 1), (0, 1, 2.0, 2), (1, 1, 3.0, 1)]), KEYS))
    assert rows.columns == schemas.OBSERVATIONS.names[:-1]
    assert rows.select("tech_key").distinct().count() == 2


def test_surrogate_key(spark):
    import hashlib

    df = spark.createDataFrame([(7, at(3)), (None, at(3))], "a int, b timestamp_ntz")
    found = [r[0] for r in df.select(surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert found == [hashlib.md5(b"7|2024-01-01 03:00:00").hexdigest(), None]
    assert df.select(compact_key(F.col("a"), F.col("b"))).distinct().count() == 2


def test_time_columns(spark):
    df = spark.createDataFrame([(at(24 * 59 + 13.75),)], "t timestamp_ntz")
    t = F.col("t")
    row = df.select(
        hour_of(t).alias("h"),
        day_of(t).alias("d"),
        month_key(t).alias("ym"),
        days_before(t, 2).alias("exact"),
        days_before(t, 2, snap_to_day=True).alias("snapped"),
        version_label(t, "m_v1").alias("v"),
        *[c.alias(n) for n, c in calendar(t).items()],
    ).first()
    assert (row.h, row.d, row.ym) == (at(24 * 59 + 13), at(24 * 59), 202402)
    assert (row.exact, row.snapped) == (at(24 * 57 + 13.75), at(24 * 57))
    assert row.v == "m_v1_2024-02"
    # 29 February 2024 is a Thursday
    assert (row.hour, row.day_of_week, row.month, row.day_of_year) == (13, 3, 2, 60)
    assert spark.range(1).select(*backfill_range(instant("2024-02-29 05:00:00"))).first()[:] == (
        "2022-02-28",
        "2024-02-29",
    )


def test_time_columns_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        # 02:30 does not exist on the day the clocks go forward
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00' AS t")
        row = df.select(hour_of(F.col("t")).cast("string"), day_of(F.col("t")).cast("string")).first()
        assert row[:] == ("2024-03-31 02:00:00", "2024-03-31 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_means_skip_nulls_and_survive_empty_groups(spark):
    df = spark.createDataFrame([(1, 0.1), (1, None), (1, 0.2), (2, None)], "k int, x double")
    for scale in (None, 1):
        found = df.groupBy("k").agg(
            mean(F.col("x"), scale).alias("m"), total(F.col("x"), scale).alias("s")
        )
        one, two = (found.where(f"k = {k}").first() for k in (1, 2))
        assert one.m == pytest.approx(0.15) and one.s == pytest.approx(0.3)
        assert two.m is None and two.s is None


def test_rain_label(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (None,)], "p double")
    assert [r[0] for r in df.select(rained(F.col("p"))).collect()] == [0, 1, 0]


def test_marts_keep_rows_without_a_city(spark):
    rows = raw(spark, [(0, 1, 1.0, 1), (0, 2, 2.0, 1), (0, 3, 3.0, 1)])
    hourly = marts.hourly_mart(rows, *places(spark), "2024-01-02 00:00:00")
    assert hourly.columns == schemas.HOURLY_MART.names[:-1]
    assert rows_of(hourly, "city", "country", "temperature") == [
        ("A", "X", 1.0),
        ("B", None, 2.0),
        (None, None, 3.0),
    ]
    assert hourly.where("city IS NULL AND tech_key IS NULL").count() == 1


def test_daily_mart(spark):
    rows = raw(spark, [(0, 1, 1.0, 1), (1, 1, 4.0, 1), (2, 1, None, 1), (24, 1, 9.0, 1)])
    rows = rows.withColumn(
        "precipitation", F.when(F.hour("timestamp") == 1, 0.5).otherwise(F.col("precipitation"))
    )
    daily = marts.daily_mart(rows, *places(spark), "2024-01-02 00:00:00")
    assert daily.columns == schemas.DAILY_MART.names[:-1]
    first = daily.where("observation_date = DATE '2024-01-01'").first()
    assert (first.avg_temperature, first.thermal_range, first.rainy_hours) == (2.5, 3.0, 1)
    assert first.total_precipitation == 0.5


def test_replace_keys_is_null_safe(spark):
    target = spark.createDataFrame([("a", 1, 1), (None, 1, 1), (None, 2, 1)], "c string, t int, v int")
    batch = spark.createDataFrame([(None, 1, 7), ("b", 1, 7)], "c string, t int, v int")
    merged = upsert.replace_keys(target, batch, ("c", "t"))
    assert rows_of(merged, "c", "t", "v") == [
        ("a", 1, 1),
        ("b", 1, 7),
        (None, 1, 7),
        (None, 2, 1),
    ]


def test_upsert_rewrites_only_touched_months_and_is_repeatable(spark):
    path = scratch_path(spark, "upsert")
    first = raw(spark, [(0, 1, 1.0, 1), (1, 1, 2.0, 1), (24 * 40, 1, 3.0, 1), (24 * 80, 1, 4.0, 1)])
    assert upsert.upsert(spark, path, first, KEYS, "timestamp") == [202401, 202402, 202403]
    before = {f for f in spark.read.parquet(path).inputFiles() if "202403" in f}
    batch = raw(spark, [(1, 1, 20.0, 2), (2, 1, 30.0, 2), (24 * 40 + 1, 2, 5.0, 2)])
    for _ in range(2):
        assert upsert.upsert(spark, path, batch, KEYS, "timestamp") == [202401, 202402]
        found = rows_of(spark.read.parquet(path), "temperature")
        assert found == [(1.0,), (20.0,), (3.0,), (30.0,), (4.0,), (5.0,)]
    assert before == {f for f in spark.read.parquet(path).inputFiles() if "202403" in f}
    assert upsert.upsert(spark, path, batch.limit(0), KEYS, "timestamp") == []


def test_upsert_without_a_copy_gives_the_same_table(spark):
    found = []
    for keep_copy in (True, False):
        path = scratch_path(spark, "copy")
        for rows in ([(0, 1, 1.0, 1), (1, 1, 2.0, 1)], [(1, 1, 5.0, 2), (2, 1, 6.0, 2)]):
            upsert.upsert(spark, path, raw(spark, rows), KEYS, "timestamp", keep_copy=keep_copy)
        found.append(rows_of(spark.read.parquet(path), "timestamp", "temperature"))
    assert found[0] == found[1] == [(at(0), 1.0), (at(1), 5.0), (at(2), 6.0)]


def test_a_hot_key_leaves_one_row(spark):
    """A third of all rows are copies of one hour."""
    rows = [(0, 1, float(i % 50), i) for i in range(300)] + [(1 + i, 2, 1.0, i) for i in range(600)]
    df = raw(spark, rows).repartition(8)
    for form in ("rank", "aggregate"):
        kept = keep_latest(df, KEYS, form=form)
        assert kept.count() == 601
        assert rows_of(kept.where("city_id = 1"), "temperature", "ingestion_ts") == [(49.0, at(299))]


def test_full_refresh_replaces_everything(spark):
    path = scratch_path(spark, "refresh")
    upsert.upsert(spark, path, raw(spark, [(0, 1, 1.0, 1), (24 * 40, 1, 2.0, 1)]), KEYS, "timestamp")
    upsert.upsert(spark, path, raw(spark, [(0, 1, 5.0, 1)]), KEYS, "timestamp", full_refresh=True)
    assert rows_of(spark.read.parquet(path), "temperature", "ym") == [(5.0, 202401)]


def test_first_seen_is_carried_over(spark):
    path = scratch_path(spark, "audit")
    rows = raw(spark, [(0, 1, 1.0, 1), (1, 1, 2.0, 1)]).drop("ingestion_ts")
    later = raw(spark, [(1, 1, 5.0, 1), (2, 1, 6.0, 1)]).drop("ingestion_ts")
    for batch, hour in ((rows, "10"), (later, "12")):
        upsert.upsert(spark, path, batch, KEYS, "timestamp", as_of=f"2024-01-05 {hour}:00:00")
    assert rows_of(spark.read.parquet(path), "temperature", "ingestion_ts") == [
        (1.0, at(24 * 4 + 10)),
        (5.0, at(24 * 4 + 10)),
        (6.0, at(24 * 4 + 12)),
    ]


def test_merge_latest_ignores_older_copies(spark):
    target = raw(spark, [(0, 1, 1.0, 5)])
    batch = raw(spark, [(0, 1, 2.0, 3), (1, 1, 3.0, 3)])
    once = upsert.merge_latest(target, batch, KEYS)
    assert rows_of(once, "temperature") == [(1.0,), (3.0,)]
    assert rows_of(upsert.merge_latest(once, batch, KEYS), "temperature") == [(1.0,), (3.0,)]


def test_day_layout_rewrites_only_touched_days(spark):
    path = scratch_path(spark, "days")
    first = raw(spark, [(h, 1, float(h), 1) for h in range(0, 96, 6)])
    days = [20240101, 20240102, 20240103, 20240104]
    assert upsert.upsert(spark, path, first, KEYS, "timestamp", grain="day") == days
    batch = raw(spark, [(90, 1, 500.0, 2)])
    before = {f for f in spark.read.parquet(path).inputFiles() if "day=4" not in f}
    # the stored layout decides, whatever the caller says
    assert upsert.upsert(spark, path, batch, KEYS, "timestamp") == [20240104]
    stored = spark.read.parquet(path)
    assert before == {f for f in stored.inputFiles() if "day=4" not in f}
    assert stored.count() == 16 and stored.where("temperature = 500").count() == 1
    kept = since(stored, "timestamp", instant("2024-01-02 06:00:00"), instant("2024-01-03"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "day" in filters and "ym" in filters
    assert rows_of(kept, "temperature") == sorted([(30.0,), (36.0,), (42.0,), (48.0,)], key=repr)


def test_months_of_dates(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2023, 12, 31),)], "d date")
    assert upsert.folders_of(df, "d") == [202312, 202401]
