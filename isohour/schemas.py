"""Column sets of the warehouse tables, with the descriptions stored on them."""

from __future__ import annotations

from pyspark.sql import types as T

# The measures, their payload field names and units.
MEASURES = ("temperature", "wind_speed", "wind_gusts", "precipitation", "humidity", "pressure")
PAYLOAD_FIELDS = {
    "temperature_2m": "temperature",
    "wind_speed_10m": "wind_speed",
    "wind_gusts_10m": "wind_gusts",
    "precipitation": "precipitation",
    "relative_humidity_2m": "humidity",
    "pressure_msl": "pressure",
}
DESCRIPTIONS = {
    "timestamp": "Hour of the observation",
    "observation_timestamp": "Hour of the observation",
    "observation_date": "Day of the observation",
    "city_id": "Key of the city",
    "city_name": "Name of the city",
    "city": "Name of the city",
    "country_id": "Key of the country",
    "country_name": "Name of the country",
    "country": "Name of the country",
    "latitude": "Latitude of the city",
    "longitude": "Longitude of the city",
    "temperature": "Temperature in Celsius",
    "wind_speed": "Wind speed in km/h",
    "wind_gusts": "Wind gust speed in km/h",
    "precipitation": "Precipitation in mm",
    "humidity": "Relative humidity in percent, 0 to 100",
    "pressure": "Sea-level pressure in hPa",
    "avg_temperature": "Mean temperature of the day in Celsius",
    "min_temperature": "Lowest temperature of the day in Celsius",
    "max_temperature": "Highest temperature of the day in Celsius",
    "thermal_range": "Highest minus lowest temperature of the day",
    "total_precipitation": "Precipitation of the day in mm",
    "rainy_hours": "Hours of the day with precipitation",
    "max_wind_speed": "Highest wind speed of the day in km/h",
    "avg_wind_speed": "Mean wind speed of the day in km/h",
    "max_wind_gusts": "Highest gust speed of the day in km/h",
    "avg_humidity": "Mean relative humidity of the day in percent",
    "avg_pressure": "Mean sea-level pressure of the day in hPa",
    "tech_key": "Surrogate key: a hash of the natural key",
    "ingestion_ts": "When the row was first loaded into this table",
    "update_ts": "When the row was last recomputed",
    "ym": "Folder month as yyyymm",
    "day": "Folder day of the month",
}

_D, _I, _S, _TS = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    made = T.StructType()
    for name, kind in fields:
        note = DESCRIPTIONS.get(name)
        made.add(T.StructField(name, kind, True, {"comment": note} if note else {}))
    return made


PAYLOAD = T.StructType(
    [
        T.StructField("city_id", _I),
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(_S))]
                + [T.StructField(name, T.ArrayType(_D)) for name in PAYLOAD_FIELDS]
            ),
        ),
    ]
)
DIM_COUNTRY = _struct(("country_id", _I), ("country_name", _S))
DIM_CITY = _struct(
    ("city_id", _I), ("city_name", _S), ("latitude", _D), ("longitude", _D), ("country_id", _I)
)
RAW = _struct(
    ("timestamp", _TS), ("city_id", _I), *((m, _D) for m in MEASURES), ("ingestion_ts", _TS)
)
OBSERVATIONS = _struct(
    ("timestamp", _TS),
    ("city_id", _I),
    *((m, _D) for m in MEASURES),
    ("tech_key", _S),
    ("ingestion_ts", _TS),
    ("update_ts", _TS),
)
HOURLY_MART = _struct(
    ("observation_timestamp", _TS),
    ("city", _S),
    ("longitude", _D),
    ("latitude", _D),
    ("country", _S),
    *((m, _D) for m in ("temperature", "precipitation", "wind_speed", "wind_gusts")),
    *((m, _D) for m in ("humidity", "pressure")),
    ("tech_key", _S),
    ("update_ts", _TS),
    ("ingestion_ts", _TS),
)
DAILY_MART = _struct(
    ("observation_date", T.DateType()),
    ("city", _S),
    ("longitude", _D),
    ("latitude", _D),
    ("country", _S),
    *((f"{f}_temperature", _D) for f in ("avg", "min", "max")),
    ("thermal_range", _D),
    ("total_precipitation", _D),
    ("rainy_hours", T.LongType()),
    ("max_wind_speed", _D),
    ("avg_wind_speed", _D),
    ("max_wind_gusts", _D),
    ("avg_humidity", _D),
    ("avg_pressure", _D),
    ("tech_key", _S),
    ("update_ts", _TS),
    ("ingestion_ts", _TS),
)
FORECAST_MART = _struct(
    ("forecast_timestamp", _TS),
    ("city", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("country", _S),
    ("predicted_temperature", _D),
    ("rain_probability", _D),
    ("forecast_run_ts", _TS),
    ("model_version", _S),
    ("horizon_hours", _I),
    ("tech_key", _S),
    ("ingestion_ts", _TS),
)
INGESTION_STATE = _struct(
    ("pipeline", _S),
    ("last_successful_run", _TS),
    ("window_start", _TS),
    ("window_end", _TS),
    ("rows_loaded", T.LongType()),
)
