"""Features, folds, metrics and model selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.operators import features as ft
from isohour.operators import folds, metrics
from isohour.plans import experiment
from isohour.plans.catalogue.inputs import DIGITS, cities, latest, mean_sql, with_tables
from isohour.plans.catalogue.registry import Register

register = Register()

TRAILS = ft.PRODUCTION.trails
_WINDOW = '(PARTITION BY city_id ORDER BY "timestamp")'


def _lags(trails: tuple[ft.Trail, ...], window: str = _WINDOW) -> str:
    return ", ".join(
        f"lag({t.measure}, {n}) OVER {window} AS {t.prefix}lag_{n}h" for t in trails for n in t.lags
    )


def _means(trails: tuple[ft.Trail, ...]) -> str:
    return ", ".join(
        mean_sql(
            t.measure,
            f'(PARTITION BY city_id ORDER BY "timestamp" ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)',
        )
        + f" AS {t.prefix}roll_{n}h"
        for t in trails
        for n in t.means
    )


_CALENDAR = """CAST(hour("timestamp") AS INTEGER) AS hour,
  CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
  CAST(month("timestamp") AS INTEGER) AS month,
  CAST(dayofyear("timestamp") AS INTEGER) AS day_of_year"""
_RAINED = "CAST(CASE WHEN precipitation > 0 THEN 1 ELSE 0 END AS INTEGER) AS rained"


def _features(trails: tuple[ft.Trail, ...]) -> str:
    return (
        f", trailed AS (SELECT city_id, \"timestamp\", temperature, {_RAINED}, "
        f"{_lags(trails)}, {_means(trails)}, {_CALENDAR} FROM latest)"
    )


def _complete(feature_set: ft.FeatureSet) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in feature_set.trailing())


def _features_of(
    spark: SparkSession, folder: str, feature_set: ft.FeatureSet, scale: int | None = DIGITS
) -> DataFrame:
    """Coordinates are joined last, so that they do not travel through the window's shuffle."""
    table = ft.feature_table(latest(spark, folder), feature_set, scale=scale)
    places = cities(spark, folder).select("city_id", "latitude", "longitude")
    return table.join(places, "city_id", "left")


@register(with_tables(f' SELECT city_id, "timestamp", {_lags(TRAILS)} FROM latest'))
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    table = ft.with_trails(latest(spark, folder), TRAILS, means=False)
    names = [f"{t.prefix}lag_{n}h" for t in TRAILS for n in t.lags]
    return table.select("city_id", "timestamp", *names)


@register(with_tables(f' SELECT city_id, "timestamp", {_means(TRAILS)} FROM latest'))
def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    table = ft.with_trails(latest(spark, folder), TRAILS, lags=False, scale=DIGITS)
    names = [f"{t.prefix}roll_{n}h" for t in TRAILS for n in t.means]
    return table.select("city_id", "timestamp", *names)


@register(with_tables(f' SELECT city_id, "timestamp", {_CALENDAR} FROM latest'))
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    return ft.with_calendar(latest(spark, folder)).select("city_id", "timestamp", *ft.CALENDAR)


@register(
    with_tables(
        f"""{_features(TRAILS)}
SELECT city_id, count(*) AS rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM trailed WHERE {_complete(ft.PRODUCTION)} GROUP BY city_id"""
    )
)
def feature_dropna(spark: SparkSession, folder: str) -> DataFrame:
    table = ft.with_trails(latest(spark, folder), TRAILS, scale=DIGITS)
    return (
        ft.drop_incomplete(table, ft.PRODUCTION.trailing())
        .groupBy("city_id")
        .agg(
            F.count("*").alias("rows"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
        )
    )


@register(
    with_tables(
        f"""{_features(ft.PRODUCTION.trails)}
SELECT t."timestamp", t.temperature, t.rained, {", ".join(ft.PRODUCTION.columns())}
FROM trailed t LEFT JOIN city USING (city_id) WHERE {_complete(ft.PRODUCTION)}"""
    )
)
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """The 25 production features with both targets."""
    table = _features_of(spark, folder, ft.PRODUCTION)
    return table.select("timestamp", "temperature", "rained", *ft.PRODUCTION.columns())


@register(
    with_tables(
        f"""{_features(ft.EXPERIMENT.trails)}
SELECT t."timestamp", t.temperature, {", ".join(ft.EXPERIMENT.columns())}
FROM trailed t LEFT JOIN city USING (city_id) WHERE {_complete(ft.EXPERIMENT)}"""
    )
)
def feature_table_experiment(spark: SparkSession, folder: str) -> DataFrame:
    """The 23 experiment features."""
    table = _features_of(spark, folder, ft.EXPERIMENT)
    return table.select("timestamp", "temperature", *ft.EXPERIMENT.columns())


@register(
    with_tables(
        """
SELECT o.city_id, o."timestamp", """
        + ", ".join(f"l{n}.temperature AS lag_{n}h" for n in ft.TEMPERATURE.lags)
        + " FROM latest o "
        + " ".join(
            f'LEFT JOIN latest l{n} ON l{n}.city_id = o.city_id '
            f'AND l{n}."timestamp" = o."timestamp" - INTERVAL {n} HOUR'
            for n in ft.TEMPERATURE.lags
        )
    )
)
def clock_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Lags by the clock: gaps in a series leave NULLs instead of shifting rows."""
    only_temperature = ft.FeatureSet((ft.TEMPERATURE,), ())
    rows = latest(spark, folder).select("city_id", "timestamp", "temperature")
    table = ft.feature_table(rows, only_temperature, mode="clock", complete_only=False, scale=DIGITS)
    return table.select("city_id", "timestamp", *[f"lag_{n}h" for n in ft.TEMPERATURE.lags])


@register(with_tables(f' SELECT city_id, "timestamp", precipitation, {_RAINED} FROM latest'))
def rain_label(spark: SparkSession, folder: str) -> DataFrame:
    return ft.with_rain_label(latest(spark, folder)).select(
        "city_id", "timestamp", "precipitation", "rained"
    )


@register(
    with_tables(
        f"""
SELECT count(rained) AS n, CAST(sum(rained) AS DOUBLE) / count(rained) AS rain_base_rate
FROM (SELECT {_RAINED} FROM latest)"""
    )
)
def rain_base_rate(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.base_rate(ft.with_rain_label(latest(spark, folder)))


_BLOCKS = """, hours AS (
  SELECT "timestamp", count(*) AS n FROM latest GROUP BY 1
), placed AS (
  SELECT "timestamp", n, sum(n) OVER (ORDER BY "timestamp") - n AS before,
         sum(n) OVER () AS total FROM hours
), blocks AS (
  SELECT "timestamp", n, CASE WHEN before < total - 5 * (total // 6) THEN 0
    ELSE (before - (total - 5 * (total // 6))) // (total // 6) + 1 END AS block FROM placed
)"""


@register(
    with_tables(
        f"""{_BLOCKS}
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN block = fold THEN 'test' ELSE 'train' END AS part,
       CAST(sum(n) AS BIGINT) AS rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM blocks, range(1, 6) f(fold) WHERE block <= fold GROUP BY 1, 2"""
    )
)
def time_series_folds(spark: SparkSession, folder: str) -> DataFrame:
    return folds.fold_summary(latest(spark, folder))


@register(
    with_tables(
        f"""{_BLOCKS}
SELECT city_id, "timestamp", CAST(block AS INTEGER) AS block FROM latest JOIN blocks USING ("timestamp")"""
    )
)
def fold_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return folds.with_block(latest(spark, folder)).select("city_id", "timestamp", "block")


def _naive(spark: SparkSession, folder: str) -> DataFrame:
    """Two predictors without a model: the last row and the row 24 rows ago."""
    trails = (
        ft.Trail("temperature", "temperature_", (1, 24), ()),
        ft.Trail("precipitation", "precipitation_", (1, 24), ()),
    )
    wide = ft.with_trails(ft.with_rain_label(latest(spark, folder)), trails)
    both = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f"lag_{n}").alias("model"),
                    F.col(f"temperature_lag_{n}h").alias("predicted"),
                    F.col(f"precipitation_lag_{n}h").alias("score"),
                )
                for n in (1, 24)
            ]
        )
    )
    return wide.select("temperature", "rained", both.alias("p")).select(
        "temperature", "rained", "p.*"
    )


_NAIVE = f""", naive AS (
  SELECT 'lag_' || n AS model, temperature, {_RAINED},
         CASE n WHEN 1 THEN lag(temperature, 1) OVER w ELSE lag(temperature, 24) OVER w END AS predicted,
         CASE n WHEN 1 THEN lag(precipitation, 1) OVER w ELSE lag(precipitation, 24) OVER w END AS score
  FROM latest, (VALUES (1), (24)) lags(n)
  WINDOW w AS (PARTITION BY n, city_id ORDER BY "timestamp"))"""
_ERRORS = """, errors AS (
  SELECT model, CAST(temperature AS DECIMAL(18,2)) - CAST(predicted AS DECIMAL(18,2)) AS e
  FROM naive
), scores AS (
  SELECT model, count(e) AS n,
         sqrt(CAST(sum(CAST(e * e AS DECIMAL(38,4))) AS DOUBLE) / count(e)) AS rmse,
         CAST(sum(abs(e)) AS DOUBLE) / count(e) AS mae
  FROM errors GROUP BY model)"""


@register(with_tables(f"{_NAIVE}{_ERRORS} SELECT * FROM scores"))
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.regression_metrics(
        _naive(spark, folder), "temperature", "predicted", ["model"], scale=DIGITS
    )


@register(with_tables(f"{_NAIVE}{_ERRORS} SELECT * FROM scores ORDER BY rmse LIMIT 1"))
def leaderboard_top1(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.winner(regression_metrics(spark, folder))


@register(
    with_tables(
        f"""{_NAIVE}, scored AS (
  SELECT model, score, 0.02::DOUBLE + score / 49 * 0.96::DOUBLE AS p, rained
  FROM naive WHERE score IS NOT NULL
), grouped AS (
  SELECT model, score, p, sum(rained)::HUGEINT AS pos, sum(1 - rained)::HUGEINT AS neg
  FROM scored GROUP BY ALL
), placed AS (
  SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score) - neg AS below FROM grouped
)
SELECT model, CAST(sum(pos + neg) AS BIGINT) AS n,
       CAST(sum(pos) AS DOUBLE) / CAST(sum(pos + neg) AS DOUBLE) AS base_rate,
       CAST(sum(pos * (2 * below + neg)) AS DOUBLE)
         / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
       round(sum(-(pos * ln(p) + neg * ln(1 - p))) / CAST(sum(pos + neg) AS DOUBLE), 6) AS log_loss
FROM placed GROUP BY model"""
    )
)
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    probability = F.lit(0.02) + F.col("score") / F.lit(49) * F.lit(0.96)
    scored = metrics.classification_metrics(
        _naive(spark, folder), "rained", "score", ["model"], probability
    )
    return scored.withColumn("log_loss", F.round("log_loss", 6))


@register(
    with_tables(
        f""", pairs AS (
  SELECT "timestamp", temperature AS y,
         lag(temperature, 1) OVER (PARTITION BY city_id ORDER BY "timestamp") AS x FROM latest
), known AS (SELECT * FROM pairs WHERE x IS NOT NULL
), hours AS (SELECT "timestamp", count(*) AS n FROM known GROUP BY 1
), placed AS (
  SELECT "timestamp", n, sum(n) OVER (ORDER BY "timestamp") - n AS before,
         sum(n) OVER () AS total FROM hours
), blocks AS (
  SELECT "timestamp", CASE WHEN before < total - 5 * (total // 6) THEN 0
    ELSE (before - (total - 5 * (total // 6))) // (total // 6) + 1 END AS block FROM placed
), rows AS (SELECT y, x, block FROM known JOIN blocks USING ("timestamp")
), fits AS (
  SELECT fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
  FROM rows, range(1, 6) f(fold) WHERE block < fold GROUP BY fold
), per_fold AS (
  SELECT fold, sqrt(avg((y - a * x - b) * (y - a * x - b))) AS rmse, avg(abs(y - a * x - b)) AS mae
  FROM rows JOIN fits ON block = fold GROUP BY fold)
SELECT 'linear_regression' AS model, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae
FROM per_fold"""
    )
)
def cross_validated_linear(spark: SparkSession, folder: str) -> DataFrame:
    """Five folds of scaled linear regression on one lag, which SQL can fit in closed form."""
    one_lag = (ft.Trail("temperature", "", (1,), ()),)
    rows = ft.with_trails(latest(spark, folder), one_lag).where("lag_1h IS NOT NULL")
    linear = [c for c in experiment.candidates() if c.name == "linear_regression"]
    result = experiment.cross_validate(rows, ["lag_1h"], models=linear).results()
    return result.select(
        "model", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae")
    )


@register()
def cross_validated_models(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates with their production settings on the experiment features."""
    table = _features_of(spark, folder, ft.EXPERIMENT, None)
    result = experiment.cross_validate(table, ft.EXPERIMENT.columns()).results()
    return result.select("model", "rmse", "mae")
