import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, inference, models, registry

T0 = dt.datetime(2024, 1, 1)
REGISTRY = "k string, model_id string, model_name string, stage string, status string, created_utc timestamp, target_series string"


def _registry(spark, rows):
    return spark.createDataFrame(rows, REGISTRY)


def test_latest_model_rules(spark):
    later = T0 + dt.timedelta(days=1)
    frame = _registry(
        spark,
        [
            ("a", "1", "m", "Staging", "active", T0, "s"),
            ("a", "2", "m", "Staging", "active", later, "s"),
            ("a", "3", "m", "Staging", "inactive", later + dt.timedelta(days=1), "s"),
            ("a", "4", "m", "Archived", "active", later + dt.timedelta(days=2), "s"),
            ("b", "5", "m", "Staging", "active", T0, "s"),
            ("b", "6", "m", "Staging", "active", T0, "s"),
            ("b", "7", "other", "Staging", "active", later, "s"),
        ],
    )
    found = {(r.k, r.model_name): r.model_id for r in registry.latest_models(frame, ["k"]).collect()}
    assert found == {("a", "m"): "2", ("b", "m"): "6", ("b", "other"): "7"}
    only = registry.latest_models(frame, ["k"], model_name="other", target_series="s").collect()
    assert [r.model_id for r in only] == ["7"]
    # the whole-registry rule looks at the stage alone
    assert registry.latest_models(frame, scope="global").first().model_id == "3"
    with pytest.raises(ValueError):
        registry.latest_models(frame, scope="other")


def test_latest_model_of_an_empty_registry(spark):
    empty = _registry(spark, [])
    assert registry.latest_models(empty, ["k"]).count() == 0
    assert registry.latest_models(empty).count() == 0
    assert registry.latest_models(empty, scope="global").count() == 0


def _days(spark, n=40, key="a", start=dt.date(2024, 1, 1)):
    rows = [
        (key, start + dt.timedelta(days=i), 10 + (i * 7 % 5) + 0.1 * i, float(i % 3), float(i % 4))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k string, date date, y double, x1 double, x2 double")


def _stored(days, keys, exog=("x1", "x2")):
    return registry.serialize_model(models.train(days, keys, "date", "y", exog), keys, "r1")


def _rows(stored, keys, gate=-1e9):
    return registry.registry_rows(
        stored, keys, model_name="m", model_version="v1", target_series="s", store_table="store",
        created=T0, min_aic_improvement=gate,
    )


def test_registry_row_in_text_layout(spark):
    rows = _rows(_stored(_days(spark), []), [])
    row = registry.as_text_layout(rows).first()
    assert len(row) == 13
    assert row.order == "(1, 1, 1)" and row.seasonal_order == "(1, 1, 1, 7)"
    assert row.exog_columns == "x1,x2" and row.created_utc == "2024-01-01T00:00:00.000000+00:00"
    metrics = json.loads(row.metrics_json)
    assert set(metrics) == {"train_aic_baseline", "train_aic_sarimax", "aic_gain", "n_obs"}
    assert metrics["n_obs"] == 40 and row.mlflow_model_uri == "" and row.stage == "Staging"


def test_used_orders_are_recorded_for_short_series(spark):
    row = _rows(_stored(_days(spark, 20), []), []).first()
    assert row.seasonal_order == [0, 0, 0, 0] and row.n_obs == 20


def test_rejected_fits_are_not_registered(spark):
    assert _rows(_stored(_days(spark), ["k"]), ["k"], gate=1e9).count() == 0


def test_model_ids_name_their_series_also_for_null_keys(spark):
    days = _days(spark).unionByName(_days(spark).withColumn("k", F.lit(None).cast("string")))
    ids = [r.model_id for r in _stored(days, ["k"]).collect()]
    assert len(set(ids)) == 2
    assert _stored(_days(spark), []).first().model_id == "r1-all"


def _ready(spark, keys, horizon, daily=None, n=40):
    days = _days(spark, n)
    stored = _stored(days, keys)
    known = registry.deserialize_model(
        stored, registry.latest_models(_rows(stored, keys), keys).select(*keys, "run_id", "model_id", "order", "seasonal_order")
    )
    return inference.recent_regressors(daily or days, known, keys, "date", ["x1", "x2"], horizon)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_future_regressors_are_the_last_rows_up_to_training_end(spark, keys):
    days = _days(spark)
    later = _days(spark, 5, start=dt.date(2024, 3, 1))
    missing = days.withColumn("x1", F.when(F.col("date") == dt.date(2024, 2, 8), None).otherwise(F.col("x1")))
    plain = _ready(spark, keys, 5).first()
    assert plain.future == [[float(i % 3) for i in range(35, 40)], [float(i % 4) for i in range(35, 40)]]
    assert _ready(spark, keys, 5, days.unionByName(later)).first().future == plain.future
    masked = _ready(spark, keys, 5, missing).first()
    assert masked.future[0] == [float(i % 3) for i in (34, 35, 36, 37, 39)]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_steps_are_as_many_as_there_are_rows(spark, keys):
    steps = inference.forecast(_ready(spark, keys, 100), keys, "y")
    assert sorted(r.horizon_step for r in steps.collect()) == list(range(1, 41))
    assert dict(steps.dtypes)["horizon_step"] == "bigint"


def test_keyed_and_keyless_forecasts_agree(spark):
    a = inference.forecast(_ready(spark, [], 5), [], "y").orderBy("horizon_step").collect()
    b = inference.forecast(_ready(spark, ["k"], 5), ["k"], "y").orderBy("horizon_step").collect()
    assert [r.forecast_y for r in a] == pytest.approx([r.forecast_y for r in b])


def test_models_without_regressors_forecast_the_whole_horizon(spark):
    days = _days(spark)
    stored = _stored(days, ["k"], ())
    known = registry.deserialize_model(stored, _rows(stored, ["k"]).select("k", "run_id", "model_id", "order", "seasonal_order"))
    ready = inference.recent_regressors(days, known, ["k"], "date", [], 3)
    assert inference.forecast(ready, ["k"], "y").count() == 3


def test_a_series_with_a_null_key_is_forecast_too(spark):
    days = _days(spark).unionByName(_days(spark).withColumn("k", F.lit(None).cast("string")))
    stored = _stored(days, ["k"])
    known = registry.deserialize_model(stored, _rows(stored, ["k"]).select("k", "run_id", "model_id", "order", "seasonal_order"))
    ready = inference.recent_regressors(days, known, ["k"], "date", ["x1", "x2"], 3)
    steps = inference.forecast(ready, ["k"], "y").collect()
    assert len(steps) == 6 and {r.k for r in steps} == {"a", None}


def test_join_without_keys_is_refused(spark):
    with pytest.raises(ValueError):
        inference.join_models(_days(spark), _days(spark), [])


@pytest.mark.parametrize("model", ["sarimax", "ar1"])
def test_holdout_statuses(spark, model):
    days = _days(spark, 40).unionByName(_days(spark, 1, "b")).unionByName(_days(spark, 11, "c"))
    rows = evaluation.holdout_forecasts(
        days, ["k"], "date", "y", ["x1", "x2"] if model == "sarimax" else [], model=model
    ).collect()
    by_key = {k: [r for r in rows if r.k == k] for k in "abc"}
    assert {k: len(v) for k, v in by_key.items()} == {"a": 7, "b": 1, "c": 2}
    assert {r.status for r in by_key["b"] + by_key["c"]} == {"too_short"}
    assert all(r.forecast_y is None for r in by_key["b"] + by_key["c"])
    assert all(r.forecast_y is not None and r.status == "ok" for r in by_key["a"])


def test_metrics_leave_out_rows_without_a_forecast(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), (3.0, None)], "a double, f double")
    m = evaluation.compute_metrics(frame, "a", "f").first()
    assert (m.n, m.mae) == (2, 2.0) and m.rmse == pytest.approx(5**0.5)


def test_holdout_uses_training_days_only(spark):
    """Changing the held-out values changes no forecast."""
    days = _days(spark)
    changed = days.withColumn("y", F.when(F.col("date") > dt.date(2024, 2, 2), 99.0).otherwise(F.col("y")))
    got = [
        [r.forecast_y for r in evaluation.holdout_forecasts(d, [], "date", "y", ["x1"]).orderBy("date").collect()]
        for d in (days, changed)
    ]
    assert len(got[0]) == 7 and got[0] == pytest.approx(got[1])


def test_evaluators_agree(spark):
    from tidemark.operators.boosting import gbt_metrics

    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0)], "label double, prediction double")
    ours = evaluation.compute_metrics(frame, "label", "prediction").first()
    theirs = gbt_metrics(frame)
    assert theirs["mae"] == pytest.approx(ours.mae) and theirs["rmse"] == pytest.approx(ours.rmse)


def test_boosted_trees_split_by_time_and_learn(spark):
    from tidemark.config import JobConfig
    from tidemark.operators import boosting

    rows = boosting.feature_vectors(_days(spark, 60), ["k"], "date", "y", ["x1"])
    assert rows.count() == 53
    train, test = boosting.split_vectors(rows, ["k"], "date", 0.8)
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    model = boosting.fit_gbt(train, JobConfig(gbt_max_iter=3))
    assert model.transform(test).count() == 11
