from __future__ import annotations

from datetime import datetime, timedelta

from helpers import rows_of

from isohour.operators import bitmaps


def seen(spark, *rows):
    return spark.createDataFrame(list(rows), "city_id int, timestamp timestamp_ntz")


def test_hours_come_back_across_buckets_and_before_1970(spark):
    zero = datetime(1970, 1, 1)
    hours = [-32_769, -32_768, -32_767, -1, 0, 1, 32_768, 32_769, 65_536, 473_353]
    rows = seen(spark, *[(1, zero + timedelta(hours=h)) for h in hours for _ in range(2)])
    found = bitmaps.hour_bitmaps(rows)
    assert rows_of(bitmaps.seen_hours(found), "timestamp") == rows_of(rows.distinct(), "timestamp")
    assert rows_of(bitmaps.coverage(found), "rows", "unique_hours") == [(20, 10)]
    assert bitmaps.missing_hours(found).agg({"missing": "sum"}).first()[0] == 473_353 + 32_769 + 1 - 10


def test_merging_counts_an_hour_once_and_nulls_set_no_bit(spark):
    at = datetime(2024, 1, 1)
    one = seen(spark, (1, at), (1, at + timedelta(minutes=30)), (1, None), (None, at))
    other = seen(spark, (1, at), (1, at + timedelta(hours=3)), (2, None))
    both = bitmaps.merged(bitmaps.hour_bitmaps(one), bitmaps.hour_bitmaps(other))
    assert rows_of(bitmaps.coverage(both), "city_id", "rows", "unique_hours") == [(1, 5, 2), (2, 1, 0), (None, 1, 1)]
    gaps = rows_of(bitmaps.missing_hours(both), "city_id", "gap_start", "gap_end", "missing")
    assert gaps == [(1, at + timedelta(hours=1), at + timedelta(hours=2), 2)]
    none = bitmaps.hour_bitmaps(one.limit(0))
    assert bitmaps.coverage(none).count() == bitmaps.missing_hours(none).count() == 0
