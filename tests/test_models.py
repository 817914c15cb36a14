from __future__ import annotations

import json

import pytest
from helpers import at, rows_of, sine_series
from pyspark.sql import functions as F

import __spark_entry__ as driver
from isohour import schemas
from isohour.operators import features as ft
from isohour.operators import forecast as fc
from isohour.plans import experiment, serving, training
from isohour.session import scratch_path

HOURS = 24 * 16
AS_OF = f"{at(HOURS)}"


@pytest.fixture(scope="module")
def mart(spark):
    """Two whole series, one with too little history for a week's lag."""
    df = sine_series(spark, 3, HOURS, skip=lambda city, h: city == 2 and h < HOURS - 100)
    return df.persist()


@pytest.fixture(scope="module")
def trained(mart):
    return training.train(mart, AS_OF, iterations=40)


def naive_rmse(rows):
    return rows.select(
        F.sqrt(F.avg(F.pow(F.col("temperature") - F.col("lag_3h"), 2)))
    ).first()[0]


def test_training_beats_a_naive_predictor_and_is_repeatable(mart, trained):
    meta = trained.meta.first()
    rows = training.training_rows(mart)
    assert meta.n_rows == rows.count() == 2 * (HOURS - 168)
    assert meta.model_version == "gbt_v1_2024-01"
    assert meta.regressor.insample_rmse < naive_rmse(rows)
    assert meta.classifier.insample_auc > 0.9
    assert meta.classifier.rain_base_rate == pytest.approx(3 / 24, abs=0.01)
    again = training.train(mart, AS_OF, iterations=40)
    assert again.meta.first() == meta


def test_save_and_load(spark, mart, trained):
    path = scratch_path(spark, "model")
    training.save(trained, path)
    training.save(trained, path)
    loaded = training.load(spark, path)
    assert loaded.columns == ft.PRODUCTION.columns()
    assert loaded.meta.first().model_version == "gbt_v1_2024-01"
    rows = training.training_rows(mart).limit(20)
    for a, b in ((trained.regressor, loaded.regressor), (trained.classifier, loaded.classifier)):
        assert a.saved() == b.saved() and len(a.trees) == 40
        assert rows_of(a.predict(rows, "p"), "city", "timestamp", "p") == rows_of(b.predict(rows, "p"), "city", "timestamp", "p")


def test_forecast_follows_the_cycle(spark, mart, trained):
    made = serving.forecast(mart, trained, AS_OF, horizon=24, needed_rows=fc.NEEDED_ROWS)
    assert made.rows.columns == schemas.FORECAST_MART.names
    assert [f.dataType for f in made.rows.schema] == [f.dataType for f in schemas.FORECAST_MART]
    assert rows_of(made.skipped, "city", "history_rows") == [("city_2", 100)]
    rows = made.rows.collect()
    assert len(rows) == 48 and len({r.tech_key for r in rows}) == 48
    last = at(HOURS - 1)
    for r in rows:
        assert (r.forecast_timestamp - last).total_seconds() == 3600 * r.horizon_hours
        assert 0 <= r.rain_probability <= 1
    import math

    errors = [
        r.predicted_temperature
        - (15 + int(r.city[-1]) + 8 * math.sin(2 * math.pi * ((HOURS - 1 + r.horizon_hours) % 24) / 24))
        for r in rows
    ]
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 6


def test_first_step_equals_the_batch_model(spark, mart, trained):
    made = serving.forecast(mart, trained, AS_OF, horizon=1, needed_rows=fc.NEEDED_ROWS)
    nexts = mart.groupBy("city").agg(
        (F.max("observation_timestamp") + F.expr("INTERVAL 1 HOUR")).alias("observation_timestamp"),
        *[F.first(c).alias(c) for c in ("latitude", "longitude")],
    )
    longer = mart.unionByName(nexts, allowMissingColumns=True)
    steps = training.training_rows(longer).where(F.col("timestamp") == F.lit(AS_OF).cast("timestamp_ntz"))
    batch = trained.classifier.predict(trained.regressor.predict(steps, "t"), "r")
    assert rows_of(made.rows, "city", "predicted_temperature", "rain_probability") == rows_of(
        batch.select("city", F.round("t", 2).alias("t"), F.round("r", 4).alias("r")), "city", "t", "r"
    )


def test_short_history_can_be_forecast_with_missing_lags(mart, trained):
    made = serving.forecast(mart, trained, AS_OF, horizon=2, needed_rows=1)
    assert made.skipped.count() == 0
    assert made.rows.where("city = 'city_2'").count() == 2


def test_precipitation_feedback(spark, mart, trained):
    """Both ways, against steps made one by one from the models' batch predictions."""
    ready, _ = fc.split_by_history(serving.serving_state(mart, AS_OF), needed=fc.NEEDED_ROWS)
    start = {r.city: r.asDict() for r in ready.collect()}
    for feedback in ("probability", "last"):
        rolled = fc.expression_forecast(ready, "city", trained.regressor, trained.classifier, 4, precip_feedback=feedback)
        found = {r.city: (r.predicted_temperature, r.rain_probability) for r in rolled.collect()}
        state = {city: {k: list(v) if isinstance(v, list) else v for k, v in r.items()} for city, r in start.items()}
        made = {city: ([], []) for city in state}
        for h in range(1, 5):
            table = spark.createDataFrame(list(state.values()), ready.schema)
            known = fc.next_hour_features({m: F.col(m) for m in fc.STATE}, ft.PRODUCTION.trails, F.col("last_ts") + F.expr(f"INTERVAL {h} HOUR"))
            steps = table.select("city", *ft.PRODUCTION.statics, *[c.alias(n) for n, c in known.items()])
            for r in trained.classifier.predict(trained.regressor.predict(steps, "t"), "r").collect():
                here = state[r.city]
                here["temperature"].append(r.t)
                here["precipitation"].append(r.r if feedback == "probability" else here["precipitation"][-1])
                for m in ("humidity", "pressure"):
                    here[m].append(here[m][-1])
                made[r.city][0].append(r.t)
                made[r.city][1].append(r.r)
        for city, (t, p) in made.items():
            assert found[city][0] == pytest.approx(t) and found[city][1] == pytest.approx(p)
    with pytest.raises(ValueError):
        fc.expression_forecast(ready, "city", trained.regressor, trained.classifier, 1, precip_feedback="x")


def test_the_forecast_is_one_narrow_stage(mart, trained):
    """No checkpoint, no exchange and no Python worker between the state and the rolled arrays."""
    ready = serving.serving_state(mart, AS_OF)
    rolled = fc.expression_forecast(ready, "city", trained.regressor, trained.classifier, 3)
    before, after = (df._jdf.queryExecution().sparkPlan().toString() for df in (ready, rolled))
    for node in ("Exchange", "MapInArrow", "ArrowEvalPython", "Scan ExistingRDD"):
        assert after.count(node) == before.count(node)


def days_of(spark, path):
    stored = fc.published(spark, path)
    counts = stored.groupBy("run_date").agg(F.count("*").alias("n"))
    return {str(r.run_date): r.n for r in counts.collect()}


def test_publish_replaces_the_run_day_even_with_nothing(spark, mart, trained):
    path = scratch_path(spark, "forecast")
    assert fc.published(spark, path) is None
    rows = serving.forecast(mart, trained, AS_OF, horizon=2).rows
    fc.publish(rows, path, "2024-01-16")
    fc.publish(rows, path, "2024-01-17")
    fc.publish(rows.where("horizon_hours = 1"), path, "2024-01-17")
    assert days_of(spark, path) == {"2024-01-16": 6, "2024-01-17": 3}
    assert fc.published(spark, path, ["2024-01-17"]).count() == 3
    fc.publish(rows.limit(0), path, "2024-01-17")
    assert days_of(spark, path) == {"2024-01-16": 6}


def test_linear_forecast_equals_the_step_by_step_recursion(spark, mart):
    """The one-expression recursion with intercept, statics, calendar and a rain model."""
    import math

    ready, _ = fc.split_by_history(serving.serving_state(mart, AS_OF))
    warm = fc.Linear({"lag_1h": 0.6, "lag_24h": 0.3, "roll_6h": 0.1, "hour": 0.01, "latitude": 0.001}, 0.2)
    wet = fc.Linear({"precip_lag_1h": 1.0, "humidity_roll_6h": -0.01}, -0.5, logistic=True)
    rolled = fc.expression_forecast(ready, "city", warm, wet, horizon=30)
    for r in rolled.collect():
        start = ready.where(F.col("city") == r.city).first()
        t, p, h = list(start.temperature), list(start.precipitation), list(start.humidity)
        for step in range(1, 31):
            hour = (start.last_ts.hour + step) % 24
            temp = (
                0.6 * t[-1] + 0.3 * t[-24] + 0.1 * sum(t[-6:]) / 6 + 0.01 * hour
                + 0.001 * start.latitude + 0.2
            )
            rain = 1 / (1 + math.exp(-(p[-1] - 0.01 * sum(h[-6:]) / 6 - 0.5)))
            t.append(temp), p.append(rain), h.append(h[-1])
        assert r.predicted_temperature == pytest.approx(t[-30:])
        assert r.rain_probability == pytest.approx(p[-30:])


def test_cross_validation(spark, mart):
    rows = training.training_rows(mart)
    columns = ft.PRODUCTION.columns()
    models = experiment.candidates(iterations=30)
    done = experiment.cross_validate(rows, columns, models=models)
    assert done.fold_metrics.count() == 20
    board = done.results().collect()
    assert board[0].model == "linear_regression" and board[0].rmse < 1
    ranked = experiment.importances(spark, done.last_models["boosted_full"]).collect()
    assert len(ranked) == 25 and sum(r.importance for r in ranked) == pytest.approx(1)
    assert ranked[0].importance == max(r.importance for r in ranked)
    record = experiment.experiment_record(done.results(), AS_OF, "boosted_sampled", "steadier")
    path = scratch_path(spark, "results")
    experiment.save_record(record, path)
    saved = json.loads(spark.read.text(path).first().value)
    assert saved["rmse_winner"] == "linear_regression"
    assert saved["production_model"] == "boosted_sampled"
    assert saved["production_model_selected_manually"] is True
    assert set(saved["results"]) == {m.name for m in models}
    assert experiment.experiment_record(done.results(), AS_OF).first().production_model == "linear_regression"


def test_candidate_settings():
    by_name = {c.name: c.boosted for c in experiment.candidates()}
    assert [(s.rounds, s.rate, s.depth, s.seed) for s in by_name.values() if s] == [(300, 0.05, 6, 42)] * 3
    sampled, large, full = (by_name[f"boosted_{n}"] for n in ("sampled", "large_leaves", "full"))
    assert (sampled.row_share, sampled.feature_share, sampled.least_rows) == (0.8, 0.8, 1)
    assert large.least_rows == 20 and (full.row_share, full.feature_share) == (1.0, 1.0)
    assert by_name["linear_regression"] is None


def test_registered_models_have_production_settings(spark, monkeypatch):
    """300 rounds reach every fit of both queries; the fits themselves are left out."""
    seen = []

    class Reached(Exception):
        pass

    def stop(rows, columns, fits, *_, **__):
        seen.extend(f.settings for f in fits)
        raise Reached

    monkeypatch.setattr(experiment, "fit_all", stop)
    monkeypatch.setattr(training, "fit_all", stop)
    for name in ("cross_validated_models", "model_recursive_forecast"):
        with pytest.raises(Reached):
            driver.queries()[name](spark, "/root/testdata/sf0.001")
    assert len(seen) == 17 and {(s.rounds, s.rate, s.depth) for s in seen} == {(300, 0.05, 6)}


def test_experiment_rows(spark, mart):
    observations = mart.select(
        F.col("observation_timestamp").alias("timestamp"),
        F.col("longitude").cast("int").alias("city_id"),
        *schemas.MEASURES,
    )
    city = spark.createDataFrame(
        [(i, f"city_{i}", 40.0 + i, float(i), 1) for i in range(3)], schemas.DIM_CITY
    )
    rows = experiment.training_rows(observations, city, f"{at(0)}", f"{at(HOURS - 25)}")
    assert rows.count() == 2 * (HOURS - 24 - 168)
    assert set(ft.EXPERIMENT.columns()) <= set(rows.columns)
