"""Recursive multi-step forecasts: all series advance together, one row of arrays per series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isohour.functions.keys import surrogate_key
from isohour.functions.times import (
    calendar,
    days_before,
    instant,
    month_key,
    plus_hours,
    since,
)
from isohour.operators.features import PRODUCTION, FeatureSet, Trail
from isohour.operators.running import tail_rows
from isohour.session import shared_folder
from isohour.sources import generations

# Forecast length in hours, history read in days, rows kept per series, and the
# history that fills the longest lag.
HORIZON = 168
HISTORY_DAYS = 8
BUFFER_ROWS = 200
NEEDED_ROWS = 168
STATE = ("temperature", "precipitation", "humidity", "pressure")


def recent_history(
    df: DataFrame, as_of: str | Column, days: int = HISTORY_DAYS, ts: str = "timestamp"
) -> DataFrame:
    """The days before ``as_of``, and nothing after it."""
    return since(df, ts, days_before(instant(as_of), days), instant(as_of))


def series_snapshot(
    df: DataFrame, series: str, ts: str, constants: Sequence[str] = ()
) -> DataFrame:
    """Last hour of each series and its constants, taken from its first row."""
    return df.groupBy(series).agg(
        *[F.min_by(c, ts).alias(c) for c in constants], F.max(ts).alias("last_ts")
    )


def horizon_grid(snapshot: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Hours 1 to ``horizon`` after the last observation of each series."""
    hours = snapshot.withColumn(
        "horizon_hours", F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    )
    return hours.withColumn(
        "forecast_timestamp", plus_hours(F.col("last_ts"), F.col("horizon_hours"))
    )


def buffers(
    history: DataFrame,
    series: str,
    ts: str = "timestamp",
    measures: Sequence[str] = STATE,
    constants: Sequence[str] = (),
    rows: int = BUFFER_ROWS,
) -> DataFrame:
    """One row per series: the last ``rows`` values of each measure as an array, oldest first.

    ``constants`` do not change within a series; they come from its first kept row.
    """
    tail = tail_rows(history, rows, ts, month_key(F.col(ts)), [series])
    packed = tail.groupBy(series).agg(
        F.max(ts).alias("last_ts"),
        F.array_sort(F.collect_list(F.struct(ts, *measures))).alias("_rows"),
        *[F.min_by(c, ts).alias(c) for c in constants],
    )
    return packed.select(
        series, "last_ts", *constants, *[F.col("_rows").getField(m).alias(m) for m in measures]
    )


def split_by_history(
    state: DataFrame, measure: str = "temperature", needed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Series with at least ``needed`` rows, by default all of them, and the others.

    ``NEEDED_ROWS`` fill the longest lag; series with less have missing long lags.
    """
    rows = F.size(measure)
    return state.where(rows >= needed), state.where(rows < needed)


def lag_of(buffer: Column, n: int) -> Column:
    """The n-th value from the end; NULL when the buffer is shorter."""
    return F.try_element_at(buffer, F.lit(-n))


def mean_of(buffer: Column, n: int, scale: int | None = None) -> Column:
    """Mean of the last n values, gaps left out."""
    recent = F.slice(buffer, F.greatest(F.size(buffer) - n + 1, F.lit(1)), F.lit(n))
    present = F.filter(recent, lambda x: x.isNotNull())
    if scale is None:
        added = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    else:
        wide = f"decimal(38,{scale})"
        added = F.aggregate(
            present,
            F.lit(0).cast(wide),
            lambda a, x: (a + x.cast(f"decimal(18,{scale})")).cast(wide),
        ).cast("double")
    return F.try_divide(added, F.size(present))


def next_hour_features(
    buffer: Mapping[str, Column],
    trails: Sequence[Trail],
    forecast_ts: Column,
    scale: int | None = None,
) -> dict[str, Column]:
    """Features of the hour after the buffer's end: the same quantities training saw."""
    made: dict[str, Column] = {}
    for t in trails:
        if t.measure not in buffer:
            continue
        made |= {f"{t.prefix}lag_{n}h": lag_of(buffer[t.measure], n) for n in t.lags}
        made |= {f"{t.prefix}roll_{n}h": mean_of(buffer[t.measure], n, scale) for n in t.means}
    return made | calendar(forecast_ts)


# --- models as expressions: the whole recursion is one Catalyst expression ---


class Predictor(Protocol):
    """A fitted model that is a column expression over named features."""

    @property
    def names(self) -> Sequence[str]: ...

    def on(self, features: Mapping[str, Column]) -> Column: ...


@dataclass(frozen=True)
class Linear:
    """Intercept and weights by feature name; ``logistic`` gives a probability."""

    weights: Mapping[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    logistic: bool = False

    @classmethod
    def fitted(cls, model: LinearRegressionModel | LogisticRegressionModel, names: Sequence[str]) -> Linear:
        """The weights of a fitted Spark ML model over the columns ``names``."""
        return cls(
            dict(zip(names, model.coefficients.toArray().tolist())),
            float(model.intercept),
            isinstance(model, LogisticRegressionModel),
        )

    @property
    def names(self) -> list[str]:
        """The features that the model reads."""
        return list(self.weights)

    def on(self, features: Mapping[str, Column]) -> Column:
        value = None
        for name, weight in self.weights.items():
            term = F.lit(float(weight)) * features[name]
            value = term if value is None else value + term
        if value is None:
            value = F.lit(float(self.intercept))
        elif self.intercept:
            value = value + F.lit(float(self.intercept))
        return 1.0 / (1.0 + F.exp(-value)) if self.logistic else value


def expression_forecast(
    state: DataFrame,
    series: str,
    temperature: Predictor,
    rain: Predictor | None = None,
    horizon: int = HORIZON,
    features: FeatureSet = PRODUCTION,
    precip_feedback: str = "probability",
) -> DataFrame:
    """Roll models forward inside one fold over the hours: no step leaves the row, and the plan is one narrow stage.

    Predicted temperature and, by ``precip_feedback``, the rain ``probability`` or the ``last`` precipitation are appended to
    the buffer, humidity and pressure are carried forward. Without a rain model precipitation is carried forward as
    well. Adds the arrays ``predicted_temperature`` and ``rain_probability``.
    """
    if precip_feedback not in ("probability", "last"):
        raise ValueError(f"unknown precip_feedback {precip_feedback!r}")
    held = [m for m in STATE if m in state.columns]
    used = {*temperature.names, *(rain.names if rain else ())}
    statics = {s: F.col(s) for s in features.statics if s in state.columns}
    asked = [t for t in features.trails if used & set(t.names())]
    kept = [m for m in held if m == "temperature" or any(t.measure == m for t in asked)]
    wet = "rain_probability"

    def step(buffer: Column, h: Column) -> Column:
        now = plus_hours(F.col("last_ts"), h)
        parts = {m: buffer[m] for m in kept}
        known = next_hour_features(parts, asked, now) | statics
        added = {m: lag_of(parts[m], 1) for m in kept}
        added["temperature"] = temperature.on(known)
        if not rain:
            return F.struct(*[F.concat(parts[m], F.array(added[m])).alias(m) for m in kept])
        parts[wet] = buffer[wet]
        added[wet] = rain.on(known)
        # the probability is bound once, as two arrays may take it
        return F.get(
            F.transform(
                F.array(added[wet]),
                lambda p: F.struct(
                    *[
                        F.concat(parts[m], F.array(p if fed(m) else added[m])).alias(m)
                        for m in (*kept, wet)
                    ]
                ),
            ),
            F.lit(0),
        )

    def fed(measure: str) -> bool:
        return measure == wet or (measure == "precipitation" and precip_feedback == "probability")

    start = [F.col(m).cast("array<double>").alias(m) for m in kept]
    if rain:
        start.append(F.array().cast("array<double>").alias(wet))
    rolled = state.withColumn(
        "_end", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.struct(*start), step)
    )
    tail = {"predicted_temperature": F.slice("_end.temperature", -horizon, horizon)}
    if rain:
        tail[wet] = F.col(f"_end.{wet}")
    return rolled.withColumns(tail).drop("_end")


# --- any Spark ML model: a loop of narrow steps over the state table ---


def model_forecast(
    state: DataFrame,
    models: Transformer,
    horizon: int = HORIZON,
    features: FeatureSet = PRODUCTION,
    checkpoint_every: int = 6,
    precip_feedback: str = "probability",
) -> DataFrame:
    """Roll fitted models forward, one narrow step per hour for all series at once.

    ``models`` reads the feature columns and writes ``temperature_prediction`` and
    ``rain_probability_vector``. Every ``checkpoint_every`` hours the state is checkpointed to the
    shared folder, which bounds the plan and survives the loss of executors.
    ``precip_feedback``: what future hours see as precipitation, the rain ``probability`` or the
    ``last`` observed value.
    """
    if precip_feedback not in ("probability", "last"):
        raise ValueError(f"unknown precip_feedback {precip_feedback!r}")
    shared_folder(state.sparkSession)
    base = [c for c in state.columns if c not in STATE]
    out = ("predicted_temperature", "rain_probability")
    rolling = state.withColumns({name: F.array().cast("array<double>") for name in out})
    # the expressions are the same at every hour; the hour itself is counted by the predictions
    now = plus_hours(F.col("last_ts"), F.size(out[0]) + 1)
    known = next_hour_features({m: F.col(m) for m in STATE}, features.trails, now)
    # a linear model that lacks an input gives NaN
    warm = F.nullif(F.col("temperature_prediction"), F.lit(float("nan")))
    wet = F.nullif(vector_to_array("rain_probability_vector")[1], F.lit(float("nan")))
    added = {m: lag_of(F.col(m), 1) for m in STATE} | {"temperature": warm}
    if precip_feedback == "probability":
        added["precipitation"] = wet
    kept = [
        *[F.col(c) for c in base],
        *[F.concat(F.col(m), F.array(added[m])).alias(m) for m in STATE],
        *[F.concat(F.col(n), F.array(v)).alias(n) for n, v in zip(out, (warm, wet))],
    ]
    for h in range(1, horizon + 1):
        seen = rolling.withColumns(known)
        rolling = models.transform(seen).select(*kept)
        if h % checkpoint_every == 0 or h == horizon:
            rolling = rolling.checkpoint()
    return rolling


# --- forecast rows ---


def forecast_rows(
    rolled: DataFrame,
    run_ts: str | Column,
    version: str | Column,
    loaded_at: str | Column | None = None,
) -> DataFrame:
    """One row per series and hour, rounded and keyed, from the predicted arrays."""
    run = instant(run_ts)
    zipped = F.arrays_zip("predicted_temperature", "rain_probability")
    hours = rolled.select(
        "city", "latitude", "longitude", "country", "last_ts", F.posexplode(zipped).alias("h", "p")
    )
    stamp = plus_hours(F.col("last_ts"), F.col("h") + 1)
    version = F.lit(version) if isinstance(version, str) else version
    return hours.select(
        stamp.alias("forecast_timestamp"),
        "city",
        "latitude",
        "longitude",
        "country",
        F.round("p.predicted_temperature", 2).alias("predicted_temperature"),
        F.round("p.rain_probability", 4).alias("rain_probability"),
        run.alias("forecast_run_ts"),
        version.alias("model_version"),
        (F.col("h") + 1).alias("horizon_hours"),
        surrogate_key(F.col("city"), stamp, run).alias("tech_key"),
        (run if loaded_at is None else instant(loaded_at)).alias("ingestion_ts"),
    )


RUN_DAY = "run_date"


def publish(rows: DataFrame, path: str, run_day: str) -> None:
    """Replace one run day of the forecast table; no rows empty the day.

    Written aside and then switched, so readers of :func:`published` and a run that dies keep the
    day's former rows.
    """
    generations.replace(rows, path, RUN_DAY, run_day)


def published(
    spark: SparkSession, path: str, run_days: Sequence[str] | None = None
) -> DataFrame | None:
    """The forecast table with its run day, all days or the given ones; None before the first run."""
    stored = generations.read(spark, path, RUN_DAY, run_days)
    return None if stored is None else stored.withColumn(RUN_DAY, F.col(RUN_DAY).cast("date"))
