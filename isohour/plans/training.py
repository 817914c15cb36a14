"""Train, save and load the production temperature regressor and rain classifier."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from isohour.functions.times import instant, version_label
from isohour.operators.boosting import Ensemble, Fit, Settings, fit_all
from isohour.operators.features import PRODUCTION, FeatureSet, feature_table
from isohour.operators.metrics import classification_metrics, regression_metrics
from isohour.operators.profiles import extent
from isohour.session import materialise


@dataclass(frozen=True)
class Trained:
    regressor: Ensemble
    classifier: Ensemble
    meta: DataFrame
    columns: list[str]


def until(mart_hourly: DataFrame, as_of: str) -> DataFrame:
    """Rows known at ``as_of``, so that a training run can be repeated."""
    return mart_hourly.where(F.col("observation_timestamp") <= instant(as_of))


def training_rows(
    mart_hourly: DataFrame, features: FeatureSet = PRODUCTION, scale: int | None = None
) -> DataFrame:
    """Complete features of every city of the hourly mart."""
    rows = mart_hourly.select(
        F.col("observation_timestamp").alias("timestamp"),
        "city",
        "latitude",
        "longitude",
        "temperature",
        "precipitation",
        "humidity",
        "pressure",
    )
    return feature_table(rows, features, "city", scale=scale)


def settings(iterations: int = 300, seed: int = 42, logistic: bool = False) -> Settings:
    """Both models: trees of depth 6 at rate 0.05, each on 80 % of rows and features."""
    return Settings(rounds=iterations, rate=0.05, depth=6, row_share=0.8, feature_share=0.8, logistic=logistic, seed=seed)


def train(
    mart_hourly: DataFrame,
    as_of: str,
    iterations: int = 300,
    seed: int = 42,
    features: FeatureSet = PRODUCTION,
) -> Trained:
    """Fit both models on all rows. The in-sample metrics only show that training worked."""
    columns = features.columns()
    rows = materialise(
        training_rows(until(mart_hourly, as_of), features)
        .where(F.col("temperature").isNotNull())
        .select("city", "timestamp", "temperature", F.col("rained").cast("double"), *columns),
        "training",
    )
    fits = [
        Fit("regressor", "temperature", settings(iterations, seed)),
        Fit("classifier", "rained", settings(iterations, seed, logistic=True)),
    ]
    regressor, classifier = fit_all(rows, columns, fits, ["city", "timestamp"])
    return Trained(regressor, classifier, metadata(rows, regressor, classifier, as_of), columns)


def metadata(
    rows: DataFrame, regressor: Ensemble, classifier: Ensemble, as_of: str
) -> DataFrame:
    """One row: version, training span and in-sample metrics of both models."""
    fit = regression_metrics(
        regressor.predict(rows, "predicted"), "temperature", "predicted"
    ).first()
    rain = classification_metrics(classifier.predict(rows, "chance"), "rained", "chance").first()
    span = extent(rows, "city").first()
    names = ["boosted_trees_" + ("logistic" if m.settings.logistic else "squared") for m in (regressor, classifier)]
    values = rows.sparkSession.range(1).select(
        version_label(instant(as_of)).alias("model_version"),
        instant(as_of).alias("trained_at"),
        F.lit(span.n_rows).alias("n_rows"),
        instant(str(span.date_range_from)).alias("date_range_from"),
        instant(str(span.date_range_to)).alias("date_range_to"),
        F.struct(
            F.lit(names[0]).alias("type"),
            F.lit(round(fit.rmse, 6)).alias("insample_rmse"),
            F.lit(round(fit.mae, 6)).alias("insample_mae"),
        ).alias("regressor"),
        F.struct(
            F.lit(names[1]).alias("type"),
            F.lit(round(rain.base_rate, 4)).alias("rain_base_rate"),
            F.lit(None if rain.auc is None else round(rain.auc, 6)).cast("double").alias("insample_auc"),
            F.lit(round(rain.log_loss, 6)).alias("insample_logloss"),
        ).alias("classifier"),
    )
    return values


def save(trained: Trained, path: str) -> None:
    """Models, metadata and feature columns, each as one JSON row."""
    spark = trained.meta.sparkSession
    for name in ("regressor", "classifier"):
        row = [(json.dumps(getattr(trained, name).saved()),)]
        spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
    trained.meta.coalesce(1).write.mode("overwrite").json(f"{path}/model_meta")
    spark.createDataFrame([(trained.columns,)], "feature_cols array<string>").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/feature_cols")


def load(spark: SparkSession, path: str) -> Trained:
    models = [Ensemble.loaded(json.loads(spark.read.text(f"{path}/{name}").first().value)) for name in ("regressor", "classifier")]
    return Trained(
        *models,
        spark.read.json(f"{path}/model_meta"),
        spark.read.json(f"{path}/feature_cols").first().feature_cols,
    )
