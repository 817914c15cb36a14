"""Model metrics as aggregates over a predictions table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from isohour.functions.measures import mean
from isohour.operators.running import in_ranges, running_totals


def regression_metrics(
    predictions: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    scale: int | None = None,
) -> DataFrame:
    """Rows, RMSE and MAE per group. ``scale``: digits of both columns, for order-free sums."""
    y, p = F.col(actual), F.col(predicted)
    if scale is None:
        error = y - p
        squared, absolute = F.avg(error * error), F.avg(F.abs(error))
    else:
        kind = f"decimal(18,{scale})"
        error = y.cast(kind) - p.cast(kind)
        squared = _decimal_mean(error * error)
        absolute = _decimal_mean(F.abs(error))
    return predictions.groupBy(*by).agg(
        F.count(error).alias("n"), F.sqrt(squared).alias("rmse"), absolute.alias("mae")
    )


def _decimal_mean(value: Column) -> Column:
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def mean_over_folds(fold_metrics: DataFrame, model: str = "model") -> DataFrame:
    """Mean of the fold metrics per model."""
    return fold_metrics.groupBy(model).agg(
        F.avg("rmse").alias("rmse"),
        F.avg("mae").alias("mae"),
        F.sum("seconds").alias("seconds"),
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models from the smallest RMSE up."""
    return metrics.orderBy("rmse", "model")


def winner(metrics: DataFrame) -> DataFrame:
    return leaderboard(metrics).limit(1)


def base_rate(df: DataFrame, label: str = "rained") -> DataFrame:
    return df.agg(
        F.count(label).alias("n"), mean(F.col(label), 0).alias("rain_base_rate")
    )


def classification_metrics(
    predictions: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    probability: Column | None = None,
) -> DataFrame:
    """Rows, base rate, AUC and log loss of a 0/1 label per group.

    AUC is the share of (positive, negative) pairs the score ranks right, ties counting half. Rows
    are first counted per distinct score. The scores are then range-partitioned, and the running
    counts go range by range, so no task sees all scores.
    """
    p = F.col(score) if probability is None else probability
    clipped = F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))
    per_score = (
        predictions.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .withColumn("_p", clipped)
        .groupBy(*by, F.col(score).alias("_score"), "_p")
        .agg(
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
        )
    )
    ranged = in_ranges(per_score, "_score")
    placed = running_totals(ranged, {"neg_below": F.col("neg")}, ["_score"], F.col("_range"), by)
    loss = -(F.col("pos") * F.ln("_p") + F.col("neg") * F.ln(1 - F.col("_p")))
    n = F.sum(F.col("pos") + F.col("neg"))
    # twice the number of rightly ranked pairs is an integer; too wide for a bigint at scale
    doubled = F.sum(
        F.col("pos").cast("decimal(19,0)")
        * (2 * F.col("neg_below") + F.col("neg")).cast("decimal(19,0)")
    )
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.groupBy(*by).agg(
        n.alias("n"),
        F.try_divide(F.sum("pos").cast("double"), n).alias("base_rate"),
        F.try_divide(doubled.cast("double"), 2 * pairs).alias("auc"),
        F.try_divide(F.sum(loss), n).alias("log_loss"),
    )
