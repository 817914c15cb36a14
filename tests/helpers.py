"""Hand-made frames."""

from __future__ import annotations

from datetime import datetime, timedelta

from isohour import schemas

START = datetime(2024, 1, 1)


def at(hours: float, start: datetime = START) -> datetime:
    return start + timedelta(hours=hours)


def raw(spark, rows):
    """Rows of (hour offset, city, temperature, load hour offset); other measures follow."""
    made = [
        (at(h), city, t, 1.0, 2.0, 0.0, 50.0, 1000.0, at(loaded)) for h, city, t, loaded in rows
    ]
    return spark.createDataFrame(made, schemas.RAW)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def sine_series(spark, cities: int, hours: int, skip=lambda city, h: False):
    """Hourly marts with a daily temperature cycle and rain in the afternoon."""
    import math

    made = []
    for city in range(cities):
        for h in range(hours):
            if skip(city, h):
                continue
            t = 15 + city + 8 * math.sin(2 * math.pi * h / 24)
            rain = 1.5 if h % 24 in (15, 16, 17) else 0.0
            made.append(
                (
                    at(h),
                    f"city_{city}",
                    float(city),
                    40.0 + city,
                    "Spain",
                    round(t, 1),
                    rain,
                    5.0,
                    9.0,
                    60.0 + h % 24,
                    1010.0 + h % 7,
                    f"{city}-{h}",
                    at(h),
                    at(h),
                )
            )
    return spark.createDataFrame(made, schemas.HOURLY_MART)
