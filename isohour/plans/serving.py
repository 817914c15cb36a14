"""The daily forecast run: recent history -> buffers -> both models -> forecast table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from isohour.operators import forecast as fc
from isohour.plans.training import Trained
from isohour.session import materialise


@dataclass(frozen=True)
class Forecast:
    rows: DataFrame
    skipped: DataFrame


def serving_state(
    mart_hourly: DataFrame, as_of: str, history_days: int = fc.HISTORY_DAYS
) -> DataFrame:
    """The buffers of the last days, one row per city."""
    history = fc.recent_history(mart_hourly, as_of, history_days, "observation_timestamp").where(
        F.col("city").isNotNull()
    )
    return fc.buffers(
        history,
        "city",
        "observation_timestamp",
        constants=("latitude", "longitude", "country"),
    )


def forecast(
    mart_hourly: DataFrame,
    trained: Trained,
    as_of: str,
    horizon: int = fc.HORIZON,
    history_days: int = fc.HISTORY_DAYS,
    needed_rows: int = 1,
) -> Forecast:
    """Forecast every city; those with less than ``needed_rows`` of history are listed in ``skipped``.

    The trees see missing long lags of short series and send them down one branch.
    ``history_days`` above the default makes up for gaps.
    """
    state = materialise(serving_state(mart_hourly, as_of, history_days), "state")
    ready, short = fc.split_by_history(state, needed=needed_rows)
    rolled = fc.expression_forecast(ready, "city", trained.regressor, trained.classifier, horizon)
    version = trained.meta.select("model_version").first().model_version
    rows = fc.forecast_rows(rolled, as_of, version)
    skipped = short.select("city", "last_ts", F.size("temperature").alias("history_rows"))
    return Forecast(rows, skipped)


def run(mart_hourly: DataFrame, trained: Trained, as_of: str, path: str) -> Forecast:
    """Forecast and publish as the run of the day of ``as_of``."""
    made = forecast(mart_hourly, trained, as_of)
    fc.publish(made.rows, path, as_of[:10])
    return made
