"""Serving inputs, recursive forecasts and publishing."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import instant, month_key, plus_hours, version_label
from isohour.operators import features as ft
from isohour.operators import forecast as fc
from isohour.operators import marts
from isohour.operators.running import tail_rows
from isohour.plans import serving, training
from isohour.plans.catalogue.inputs import (
    AS_OF,
    DIGITS,
    cities,
    countries,
    latest,
    with_tables,
)
from isohour.plans.catalogue.registry import Register
from isohour.session import materialise, scratch_path

register = Register()


@register(
    with_tables(
        """
SELECT city_id, "timestamp", temperature, precipitation, humidity, pressure FROM (
  SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY "timestamp" DESC) AS back FROM latest)
WHERE back <= 200"""
    )
)
def tail_per_series(spark: SparkSession, folder: str) -> DataFrame:
    rows = latest(spark, folder).select("city_id", "timestamp", *fc.STATE)
    return tail_rows(
        rows, fc.BUFFER_ROWS, "timestamp", month_key(F.col("timestamp")), ["city_id"]
    )


_PLACED = """, placed AS (
  SELECT o.city_id, o."timestamp", c.city_name AS city, c.latitude, c.longitude,
         r.country_name AS country
  FROM latest o LEFT JOIN city c ON o.city_id = c.city_id
  LEFT JOIN country r ON c.country_id = r.country_id
), snapshot AS (
  SELECT city_id, arg_min(latitude, "timestamp") AS latitude,
         arg_min(longitude, "timestamp") AS longitude, arg_min(country, "timestamp") AS country,
         max("timestamp") AS last_ts
  FROM placed GROUP BY city_id)"""


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    placed = marts.with_geography(
        latest(spark, folder).select("city_id", "timestamp"),
        cities(spark, folder),
        countries(spark, folder),
    )
    return fc.series_snapshot(placed, "city_id", "timestamp", ("latitude", "longitude", "country"))


@register(with_tables(_PLACED + " SELECT * FROM snapshot"))
def series_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(spark, folder)


@register(
    with_tables(
        _PLACED
        + """ SELECT city_id, CAST(h AS INTEGER) AS horizon_hours,
  last_ts + h * INTERVAL 1 HOUR AS forecast_timestamp
FROM snapshot, range(1, 169) g(h)"""
    )
)
def horizon_grid(spark: SparkSession, folder: str) -> DataFrame:
    return fc.horizon_grid(_snapshot(spark, folder)).select(
        "city_id", "horizon_hours", "forecast_timestamp"
    )


def _seed_sql() -> str:
    columns = []
    for t in ft.PRODUCTION.trails:
        columns += [f"list_extract({t.measure}, -{n}) AS {t.prefix}lag_{n}h" for n in t.lags]
        columns += [
            f"CAST(list_sum(list_transform({t.measure}[-{n}:], lambda x: CAST(x AS DECIMAL(18,2)))) "
            f"AS DOUBLE) / len({t.measure}[-{n}:]) AS {t.prefix}roll_{n}h"
            for n in t.means
        ]
    return ", ".join(columns)


_BUFFERS = """, tail AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY "timestamp" DESC) AS back
    FROM latest)
  WHERE back <= 200
), buffers AS (
  SELECT city_id, max("timestamp") AS last_ts,
         list(temperature ORDER BY "timestamp") AS temperature,
         list(precipitation ORDER BY "timestamp") AS precipitation,
         list(humidity ORDER BY "timestamp") AS humidity,
         list(pressure ORDER BY "timestamp") AS pressure
  FROM tail GROUP BY city_id)"""


def _buffers(spark: SparkSession, folder: str) -> DataFrame:
    return fc.buffers(latest(spark, folder), "city_id")


@register(
    with_tables(
        f"""{_BUFFERS}, next_hour AS (
  SELECT *, last_ts + INTERVAL 1 HOUR AS ts FROM buffers)
SELECT city_id, last_ts, {_seed_sql()},
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS day_of_year
FROM next_hour"""
    )
)
def forecast_seed_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the first forecast hour, from the buffer of each series."""
    state = _buffers(spark, folder)
    known = fc.next_hour_features(
        {m: F.col(m) for m in fc.STATE},
        ft.PRODUCTION.trails,
        plus_hours(F.col("last_ts"), F.lit(1)),
        DIGITS,
    )
    return state.select("city_id", "last_ts", *[c.alias(n) for n, c in known.items()])


@register(
    with_tables(
        f"""{_BUFFERS}, ready AS (
  SELECT city_id, last_ts, temperature AS buf FROM buffers
), rolled AS (
  SELECT city_id, last_ts, buf, 0 AS h FROM ready
  UNION ALL
  SELECT city_id, last_ts,
         list_append(buf, 0.5::DOUBLE * buf[-1] + 0.25::DOUBLE * buf[-24] + 0.25::DOUBLE * buf[-168]),
         h + 1 FROM rolled WHERE h < 168
)
SELECT city_id, CAST(h AS INTEGER) AS horizon_hours,
       last_ts + h * INTERVAL 1 HOUR AS forecast_timestamp,
       round(buf[-1], 6) AS predicted_temperature
FROM rolled WHERE h > 0""",
        recursive=True,
    )
)
def linear_recursive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    state = _buffers(spark, folder)
    model = fc.Linear({"lag_1h": 0.5, "lag_24h": 0.25, "lag_168h": 0.25})
    rolled = fc.expression_forecast(state, "city_id", model)
    hours = rolled.select("city_id", "last_ts", F.posexplode("predicted_temperature").alias("h", "t"))
    return hours.select(
        "city_id",
        (F.col("h") + 1).alias("horizon_hours"),
        plus_hours(F.col("last_ts"), F.col("h") + 1).alias("forecast_timestamp"),
        F.round("t", 6).alias("predicted_temperature"),
    )


@register(
    with_tables(
        f"""{_BUFFERS}
SELECT city_id, last_ts, len(temperature) AS history_rows,
       CASE WHEN len(temperature) >= 168 THEN 'forecast' ELSE 'skipped' END AS outcome
FROM buffers""",
        series=97,
    )
)
def history_split(spark: SparkSession, folder: str) -> DataFrame:
    """Series with a week of history and those skipped for lack of it."""
    state = fc.buffers(latest(spark, folder, series=97), "city_id")
    ready, short = fc.split_by_history(state, needed=fc.NEEDED_ROWS)
    outcome = ready.withColumn("outcome", F.lit("forecast")).unionByName(
        short.withColumn("outcome", F.lit("skipped"))
    )
    return outcome.select(
        "city_id", "last_ts", F.size("temperature").cast("bigint").alias("history_rows"), "outcome"
    )


_FITTED_SQL = with_tables(
    f"""{_BUFFERS}, ready AS (
  SELECT city_id, last_ts, temperature AS buf FROM buffers
), pairs AS (
  SELECT temperature AS y,
         lag(temperature, 24) OVER (PARTITION BY city_id ORDER BY "timestamp") AS x FROM latest
), fit AS (
  SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs WHERE x IS NOT NULL
), rolled AS (
  SELECT city_id, last_ts, buf, 0 AS h FROM ready
  UNION ALL
  SELECT city_id, last_ts, list_append(buf, a * buf[-24] + b), h + 1 FROM rolled, fit WHERE h < 168
)
SELECT city_id, CAST(h AS INTEGER) AS horizon_hours, round(buf[-1], 4) AS predicted_temperature
FROM rolled WHERE h > 0""",
    recursive=True,
)


def _fitted(spark: SparkSession, folder: str) -> tuple[DataFrame, PipelineModel]:
    """Buffers and models on the value 24 rows ago, which SQL can fit in closed form."""
    trails = (ft.Trail("temperature", "", (24,), ()),)
    rows = ft.with_rain_label(ft.with_trails(latest(spark, folder), trails)).select(
        "temperature", F.col("rained").cast("double"), "lag_24h"
    )
    training_set = materialise(rows.where("lag_24h IS NOT NULL"), "training")
    models = Pipeline(
        stages=[
            VectorAssembler(inputCols=["lag_24h"], outputCol="features", handleInvalid="keep"),
            LinearRegression(
                labelCol="temperature", predictionCol="temperature_prediction", solver="normal"
            ),
            LogisticRegression(
                labelCol="rained",
                predictionCol="",
                rawPredictionCol="",
                probabilityCol="rain_probability_vector",
            ),
        ]
    ).fit(training_set)
    return materialise(_buffers(spark, folder), "state"), models


def _predicted(rolled: DataFrame) -> DataFrame:
    hours = rolled.select("city_id", F.posexplode("predicted_temperature").alias("h", "t"))
    return hours.select(
        "city_id",
        (F.col("h") + 1).alias("horizon_hours"),
        F.round("t", 4).alias("predicted_temperature"),
    )


@register(_FITTED_SQL)
def fitted_linear_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted linear models rolled forward as one expression."""
    state, models = _fitted(spark, folder)
    warm, wet = (fc.Linear.fitted(m, ["lag_24h"]) for m in models.stages[1:])
    return _predicted(fc.expression_forecast(state, "city_id", warm, wet))


@register(_FITTED_SQL)
def fitted_loop_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The same models rolled forward by the loop that takes any fitted model."""
    state, models = _fitted(spark, folder)
    return _predicted(fc.model_forecast(state, models))


_RUNS = ("2024-01-29 04:30:00", "2024-01-30 04:30:00", "2024-01-30 18:00:00")
_PUBLISH_SQL = ", ".join(f"(TIMESTAMP '{run}')" for run in _RUNS)


@register(
    with_tables(
        f""", runs(run_ts) AS (VALUES {_PUBLISH_SQL}
), ends AS (
  SELECT run_ts, city_id, max("timestamp") AS last_ts,
         arg_max(temperature, "timestamp") AS temperature,
         arg_max(precipitation, "timestamp") AS precipitation
  FROM latest, runs WHERE "timestamp" <= run_ts GROUP BY ALL
), made AS (
  SELECT e.last_ts + h * INTERVAL 1 HOUR AS forecast_timestamp, c.city_name AS city, c.latitude,
         c.longitude, r.country_name AS country, round(e.temperature, 2) AS predicted_temperature,
         round(e.precipitation / 49, 4) AS rain_probability, e.run_ts AS forecast_run_ts,
         'persistence_v1_2024-01' AS model_version, CAST(h AS INTEGER) AS horizon_hours,
         md5(c.city_name || '|' || strftime(e.last_ts + h * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
             || '|' || strftime(e.run_ts, '%Y-%m-%d %H:%M:%S')) AS tech_key,
         e.run_ts AS ingestion_ts
  FROM ends e JOIN city c USING (city_id) LEFT JOIN country r USING (country_id),
       range(1, 169) g(h)
)
SELECT * FROM made m WHERE forecast_run_ts = (
  SELECT max(run_ts) FROM runs WHERE CAST(run_ts AS DATE) = CAST(m.forecast_run_ts AS DATE))"""
    )
)
def forecast_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs on one day and one the day before, published in turn: the later run of a day replaces
    the earlier."""
    path = scratch_path(spark, "forecast")
    placed = marts.with_geography(
        latest(spark, folder), cities(spark, folder), countries(spark, folder)
    ).where(F.col("city").isNotNull())
    for run in _RUNS:
        known = placed.where(F.col("timestamp") <= instant(run))
        ends = known.groupBy("city").agg(
            F.max("timestamp").alias("last_ts"),
            *[F.min_by(c, "timestamp").alias(c) for c in ("latitude", "longitude", "country")],
            *[F.max_by(c, "timestamp").alias(c) for c in ("temperature", "precipitation")],
        )
        held = ends.withColumns(
            {
                "predicted_temperature": F.array_repeat("temperature", fc.HORIZON),
                "rain_probability": F.array_repeat(F.col("precipitation") / 49, fc.HORIZON),
            }
        )
        version = version_label(instant(run), "persistence_v1")
        fc.publish(fc.forecast_rows(held, run, version), path, run[:10])
    return fc.published(spark, path).drop(fc.RUN_DAY)


@register()
def model_recursive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Train both boosted-tree models on the hourly mart and forecast a week for every city."""
    mart = marts.hourly_mart(
        latest(spark, folder), cities(spark, folder), countries(spark, folder), AS_OF
    )
    trained = training.train(mart, AS_OF)
    return serving.forecast(mart, trained, AS_OF, history_days=12).rows
