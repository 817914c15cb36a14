"""Compare candidate temperature models by time-ordered cross-validation."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isohour.functions.times import instant, since
from isohour.operators.boosting import Ensemble, Fit, Settings, fit_all, scores_of_folds
from isohour.operators.features import EXPERIMENT, FeatureSet, feature_table
from isohour.operators.folds import with_block
from isohour.operators.forecast import Linear
from isohour.operators.metrics import leaderboard, mean_over_folds, regression_metrics
from isohour.operators.moments import block_moments, expanding_fits
from isohour.session import materialise

FOLD_METRICS = "model string, fold int, n bigint, rmse double, mae double, seconds double"


@dataclass(frozen=True)
class Candidate:
    """Boosted trees with these settings; linear regression on scaled features without."""

    name: str
    boosted: Settings | None = None


def candidates(iterations: int = 300, seed: int = 42) -> list[Candidate]:
    """Boosted trees on samples, on samples with large leaves, and on all rows; scaled linear regression."""
    full = Settings(rounds=iterations, seed=seed)
    sampled = replace(full, row_share=0.8, feature_share=0.8)
    return [
        Candidate("boosted_sampled", sampled),
        Candidate("boosted_large_leaves", replace(sampled, least_rows=20)),
        Candidate("boosted_full", full),
        Candidate("linear_regression"),
    ]


def training_rows(
    observations: DataFrame,
    city: DataFrame,
    start: str,
    end: str,
    features: FeatureSet = EXPERIMENT,
) -> DataFrame:
    """Observations of a closed time range with coordinates and complete features."""
    rows = since(observations, "timestamp", instant(start), instant(end))
    places = city.select("city_id", "city_name", "latitude", "longitude")
    return feature_table(rows, features).join(places, "city_id", "left")


@dataclass(frozen=True)
class Experiment:
    fold_metrics: DataFrame
    last_models: dict[str, Ensemble | Linear]

    def results(self) -> DataFrame:
        return leaderboard(mean_over_folds(self.fold_metrics))


def cross_validate(
    rows: DataFrame,
    columns: Sequence[str],
    target: str = "temperature",
    models: Sequence[Candidate] | None = None,
    folds: int = 5,
) -> Experiment:
    """Fit every model on every fold; only models and metrics reach the driver.

    All boosted fits are grown together. Linear fits take one scan: moments per block, whose running sums are the
    moments of the expanding folds. One more scan scores every model on the fold that each row is the test of. Rows
    are read often, so they are written to the shared folder once.
    """
    spark = rows.sparkSession
    labelled = rows.where(F.col(target).isNotNull())
    plain = [F.col(c).cast("double").alias(c) for c in columns]
    blocked = materialise(with_block(labelled.select("timestamp", F.col(target).cast("double").alias("label"), *plain), folds=folds), "folds")
    chosen = list(models or candidates())
    fitted: dict[str, dict[int, Ensemble | Linear]] = {}
    seconds: dict[str, float] = {}

    boosted = [c for c in chosen if c.boosted]
    if boosted:
        began = time.perf_counter()
        fits = [Fit(c.name, "label", c.boosted, fold) for c in boosted for fold in range(1, folds + 1)]
        for fit, model in zip(fits, fit_all(blocked, columns, fits, ["timestamp", *columns])):
            fitted.setdefault(fit.name, {})[fit.before] = model
        seconds |= {c.name: (time.perf_counter() - began) / len(boosted) for c in boosted}
    for candidate in chosen:
        if not candidate.boosted:
            began = time.perf_counter()
            fitted[candidate.name] = expanding_fits(block_moments(blocked, columns, "label"), columns, folds)
            seconds[candidate.name] = time.perf_counter() - began

    scores = scored(blocked, fitted, columns)
    metrics = regression_metrics(scores, "label", "prediction", ["model", "fold"]).collect()
    timed = [(*m, seconds[m.model] / folds) for m in metrics]
    return Experiment(
        spark.createDataFrame(timed, FOLD_METRICS),
        {name: models[max(models)] for name, models in fitted.items() if models},
    )


def scored(blocked: DataFrame, fitted: dict[str, dict[int, Ensemble | Linear]], columns: Sequence[str]) -> DataFrame:
    """Every model's prediction of the rows that its fold tests: one scan for all ensembles, one for the linear models."""
    parts = []
    features = {c: F.col(c) for c in columns}
    boosted = [(name, fold, m) for name, models in fitted.items() for fold, m in models.items() if isinstance(m, Ensemble)]
    if boosted:
        parts.append(scores_of_folds(blocked, boosted, columns))
    for name, models in fitted.items():
        cases = [(F.col("block") == fold, model.on(features)) for fold, model in models.items() if isinstance(model, Linear)]
        if cases:
            chosen: Column = reduce(lambda so_far, case: so_far.when(*case), cases[1:], F.when(*cases[0]))
            tested = blocked.where(F.col("block").isin(*models))
            parts.append(tested.select(F.lit(name).alias("model"), F.col("block").alias("fold"), "label", chosen.alias("prediction")))
    return reduce(DataFrame.unionByName, parts)


def importances(spark: SparkSession, model: Ensemble) -> DataFrame:
    """Feature importances of a fitted ensemble, shares of the gain, greatest first."""
    return spark.createDataFrame(model.importances(), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def experiment_record(
    results: DataFrame, as_of: str, production_model: str | None = None, reason: str | None = None
) -> DataFrame:
    """One row: the winner by RMSE, the model chosen for production and all scores."""
    scores = F.map_from_entries(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "model",
                    F.struct(
                        F.round("rmse", 6).alias("rmse"),
                        F.round("mae", 6).alias("mae"),
                        F.round("seconds", 3).alias("seconds"),
                    ).alias("scores"),
                )
            )
        )
    )
    best = F.min_by("model", F.struct("rmse", "model"))
    return results.agg(
        instant(as_of).alias("run_date"),
        best.alias("rmse_winner"),
        (F.lit(production_model) if production_model else best).alias("production_model"),
        F.lit(production_model is not None).alias("production_model_selected_manually"),
        F.lit(reason).cast("string").alias("production_model_reason"),
        scores.alias("results"),
    )


def save_record(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("overwrite").json(path)
