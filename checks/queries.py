"""One query for each operator, over whole given tables."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import JobConfig
from tidemark.operators import (
    boosting,
    cleaning,
    daily,
    diagnostics,
    evaluation,
    features,
    inference,
    models,
    registry,
    states,
)
from tidemark.session import ensure_checkpoint_dir, ship_package
from tidemark.sources import TableStore, append_new_files, read_csv_from_files, read_parquet

from .inputs import LINE_AVERAGES, POSITIVE, clean_lines, clean_rows_of, daily_events, daily_lines, present, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BY_TYPE = ("event_type",)
BY_USER = ("user_id",)
VALUE = "avg_value"
EXOG = ("n_events",)
HORIZON = 5


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def scratch_path(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, where every executor can read it."""
    ensure_checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Write a costly intermediate result once, for several uses."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# sources and sinks


@query
def parquet_scan(spark, sf_dir):
    return present(read_parquet(spark, f"{sf_dir}/orders.parquet"))


@query
def csv_lookup_scan(spark, sf_dir):
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    path = scratch_path(spark)
    table(spark, sf_dir, "part").select(*columns).write.option("header", "true").csv(path)
    return read_csv_from_files(spark, path, columns)


@query
def table_overwrite_and_append(spark, sf_dir):
    """Overwrite a table, then append rows that bring a new column."""
    store = TableStore(spark)
    name = f"daily_events_{uuid.uuid4().hex}"
    days = daily_events(spark, sf_dir, *BY_TYPE)
    store.overwrite(days, name, replace_schema=True)
    store.append(features.add_calendar_features(days).drop(VALUE), name)
    added = ("day_of_week", "day_of_month", "week_of_year", "month", "quarter", "is_weekend")
    rows = kept(store.read(name).withColumns({c: F.col(c).cast("double") for c in added}))
    store.drop(name)
    return present(rows)


# projections and filters


@query
def positive_rows(spark, sf_dir):
    return present(cleaning.positive_rows(table(spark, sf_dir, "lineitem"), POSITIVE))


@query
def clean_rows(spark, sf_dir):
    return present(clean_lines(spark, sf_dir))


@query
def timestamp_casts(spark, sf_dir):
    """Text to timestamps, with the number of texts that are none."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "no date").otherwise(F.col("o_orderdate").cast("string")).alias("ts"),
    )
    bad = cleaning.bad_timestamp(["ts"]).alias("bad")
    return present(cleaning.to_timestamps(text.select("*", bad), ["ts"]))


@query
def stage_filter(spark, sf_dir):
    return present(table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F"))


@query
def complete_exog_cases(spark, sf_dir):
    """Regressor columns as doubles, on days where nothing is missing."""
    lagged = features.add_lag_features(daily_events(spark, sf_dir, *BY_USER), VALUE, [1, 2], BY_USER)
    x = ["avg_value_lag_1", "avg_value_lag_2", "n_events"]
    ready = daily.complete_cases(lagged, [VALUE, *x], "date")
    return present(ready.select(*BY_USER, "date", VALUE, *(F.col(c).cast("double").alias(c) for c in x)))


# aggregates


@query
def row_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def quality_report(spark, sf_dir):
    return present(cleaning.quality_report(table(spark, sf_dir, "lineitem"), POSITIVE, ("l_shipdate",)))


@query
def daily_features(spark, sf_dir):
    return present(daily_lines(spark, sf_dir).orderBy("date"))


@query
def daily_features_by_type(spark, sf_dir):
    return present(daily_events(spark, sf_dir, *BY_TYPE))


@query
def daily_features_by_supplier(spark, sf_dir):
    return present(daily_lines(spark, sf_dir, "l_suppkey"))


@query
def merged_daily_states(spark, sf_dir):
    """States of returned and other lines, made apart, give the features of all lines."""
    lines, columns = clean_lines(spark, sf_dir), ("n_rows", ["l_suppkey"], "date")
    parts = [
        states.daily_states(lines.where(part), "l_shipdate", LINE_AVERAGES, *columns)
        for part in (F.col("l_returnflag"), ~F.col("l_returnflag"))
    ]
    return present(states.features_of_states(parts[0].unionByName(parts[1]), LINE_AVERAGES, *columns))


@query
def daily_features_from_new_files(spark, sf_dir):
    """Take in the files of the table as a stream, twice: the second time nothing is new."""
    store, columns = TableStore(spark), ("n_rows", ["l_suppkey"], "date")
    name = f"line_states_{uuid.uuid4().hex}"
    for _ in range(2):
        append_new_files(
            store,
            f"{sf_dir}/lineitem*.parquet",
            name,
            lambda rows: states.daily_states(clean_rows_of(rows), "l_shipdate", LINE_AVERAGES, *columns),
        )
    days = kept(states.features_of_states(store.read(name), LINE_AVERAGES, *columns))
    store.drop(name)
    return present(days)


@query
def series_lengths(spark, sf_dir):
    return daily.series_lengths(daily_lines(spark, sf_dir, "l_partkey"), ["l_partkey"], 10)


# windows, splits, top-k


@query
def period_index(spark, sf_dir):
    return present(daily.period_index(daily_events(spark, sf_dir, *BY_USER), BY_USER))


@query
def last_rows(spark, sf_dir):
    return present(daily.last_rows(daily_events(spark, sf_dir, *BY_USER), HORIZON, BY_USER))


@query
def holdout_split(spark, sf_dir):
    return present(features.train_test_split_ts(daily_events(spark, sf_dir, *BY_USER), BY_USER))


@query
def fraction_split(spark, sf_dir):
    return present(
        features.train_test_split_ts(
            daily_events(spark, sf_dir, *BY_USER), BY_USER, train_fraction=0.8
        )
    )


@query
def latest_row_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return present(registry.latest_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))


@query
def latest_row(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return present(registry.latest_rows(orders, [], ["o_orderdate", "o_orderkey"]))


@query
def preview(spark, sf_dir):
    return present(daily_lines(spark, sf_dir).orderBy("date").limit(10))


# features


@query
def calendar_features(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("event_id", "ts")
    return features.add_calendar_features(days, "ts").drop("ts")


@query
def lag_features(spark, sf_dir):
    return present(
        features.add_lag_features(daily_events(spark, sf_dir, *BY_USER), VALUE, [1, 2, 7], BY_USER)
    )


@query
def rolling_features(spark, sf_dir):
    return present(
        features.add_rolling_features(daily_events(spark, sf_dir, *BY_USER), VALUE, [3, 7], BY_USER), 4
    )


@query
def parsed_dates(spark, sf_dir):
    """Text dates, some of them broken, to one dated row per series and day."""
    days = daily_events(spark, sf_dir, *BY_USER).withColumn(
        "date", F.when(F.col("n_events") >= 5, "?").otherwise(F.col("date").cast("string"))
    )
    return present(features.parse_datetime_index(days, "date", BY_USER, "yyyy-MM-dd"))


# models


@query
def ar1_baseline(spark, sf_dir):
    fits = models.ar1_baseline(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE)
    return present(fits)


@query
def ar1_baseline_one_series(spark, sf_dir):
    fits = models.ar1_baseline(daily_lines(spark, sf_dir), (), "date", "avg_price")
    return present(fits.drop("sigma2"))


@query
def ar1_residuals(spark, sf_dir):
    return present(models.ar1_residuals(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE))


@query
def ar1_forecast(spark, sf_dir):
    fits = models.ar1_baseline(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE)
    steps = models.ar1_forecast(F.col("phi"), F.col("last_value"), HORIZON)
    rows = fits.select(*BY_USER, F.posexplode(steps).alias("_h", "forecast_avg_value"))
    return present(rows.select(*BY_USER, (F.col("_h") + 1).alias("horizon_step"), "forecast_avg_value"))


@query
def order_choice(spark, sf_dir):
    lengths = daily.series_lengths(daily_events(spark, sf_dir, *BY_USER), BY_USER, 10)
    order, seasonal = models.choose_order(F.col("n_obs"))
    return lengths.select(
        *BY_USER, "n_obs",
        F.array_join(order, ",").alias("order"), F.array_join(seasonal, ",").alias("seasonal_order"),
    )


def _one_order(spark, sf_dir, order, seasonal, exog=()):
    series = daily.series_rows(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, exog)
    fits = models.search_orders(series, BY_USER, [(order, seasonal)])
    return present(fits.select(*BY_USER, F.col("params")[0].alias("coefficient"), "sigma2", "aic", "n_eff"), 5)


@query
def sarimax_fit_ar1(spark, sf_dir):
    return _one_order(spark, sf_dir, (1, 0, 0), (0, 0, 0, 0))


@query
def sarimax_fit_differenced_ar1(spark, sf_dir):
    return _one_order(spark, sf_dir, (1, 1, 0), (0, 0, 0, 0))


@query
def sarimax_fit_seasonal_ar(spark, sf_dir):
    return _one_order(spark, sf_dir, (0, 0, 0), (1, 0, 0, 7))


@query
def sarimax_fit_differenced_regression(spark, sf_dir):
    return _one_order(spark, sf_dir, (0, 1, 0), (0, 0, 0, 0), EXOG)


@query
def sarimax_fit_seasonally_differenced_regression(spark, sf_dir):
    return _one_order(spark, sf_dir, (0, 1, 0), (0, 1, 0, 7), EXOG)


def _trained(spark, sf_dir, keys=BY_USER):
    return models.train(daily_events(spark, sf_dir, *keys), keys, "date", VALUE, EXOG)


@query
def sarimax_models(spark, sf_dir):
    fits = _trained(spark, sf_dir).select(
        *BY_USER, "n_obs", "n_eff", "aic", "aic_gain", "converged", "status", "sigma2",
        F.array_join("order", ",").alias("order"),
        F.array_join("seasonal_order", ",").alias("seasonal_order"),
        *(F.get("params", F.lit(i)).alias(c) for i, c in enumerate(("coefficient", "ar", "ma"))),
    )
    return present(fits, 4)


@query
def sarimax_models_one_series(spark, sf_dir):
    fits = models.train(daily_lines(spark, sf_dir), (), "date", "avg_price", ("avg_quantity", "n_rows"))
    return fits.select("n_obs", "n_eff", "aic", "aic_gain", "converged", "status")


@query
def aic_gate(spark, sf_dir):
    """Which fits beat their baseline by enough, scored on the same days."""
    fits = models.train(
        daily_events(spark, sf_dir, *BY_TYPE), BY_TYPE, "date", VALUE, EXOG, aic_basis="common"
    )
    return present(fits.select(*BY_TYPE, "aic_gain", "status", models.passes_gate(1.0).alias("registered")), 4)


def _closed_form(spark, sf_dir, basis="own"):
    """Candidate (0,1,0)(0,1,0,7) with one regressor: a regression, so that SQL can follow."""
    days = daily_events(spark, sf_dir, *BY_TYPE)
    return models.train(
        days, BY_TYPE, "date", VALUE, EXOG, (0, 1, 0), (0, 1, 0, 7), aic_basis=basis
    )


@query
def aic_gain_and_gate(spark, sf_dir):
    fits = _closed_form(spark, sf_dir).withColumn("registered", models.passes_gate(1.0))
    return present(
        fits.select(
            *BY_TYPE, "n_obs", "n_eff", F.col("params")[0].alias("coefficient"),
            F.col("baseline.aic").alias("train_aic_baseline"), F.col("aic").alias("train_aic_sarimax"),
            "aic_gain", "status", "registered", "train_start", "train_end",
        )
    )


@query
def aic_gain_on_common_days(spark, sf_dir):
    fits = _closed_form(spark, sf_dir, "common")
    return present(
        fits.select(
            *BY_TYPE, F.col("baseline.n_eff").alias("n_eff_baseline"), "n_eff",
            F.col("baseline.phi").alias("phi"), F.col("baseline.aic").alias("train_aic_baseline"), "aic_gain",
        )
    )


@query
def closed_form_residuals(spark, sf_dir):
    rows = models.residuals(_closed_form(spark, sf_dir), BY_TYPE)
    return present(rows.filter(~F.col("burn_in")).drop("burn_in"))


@query
def closed_form_forecast(spark, sf_dir):
    """Train, gate, register, find the newest model, forecast: all steps, checked by SQL."""
    stored = kept(registry.serialize_model(_closed_form(spark, sf_dir), BY_TYPE, "run"))
    rows = registry.registry_rows(
        stored, BY_TYPE, model_name="value_per_day", model_version="v1", target_series="daily_events",
        store_table="models", created=datetime.now(timezone.utc), min_aic_improvement=-1000.0,
    )
    newest = registry.latest_models(rows, BY_TYPE).select(
        *BY_TYPE, "run_id", "model_id", "order", "seasonal_order"
    )
    ready = inference.recent_regressors(
        daily_events(spark, sf_dir, *BY_TYPE), registry.deserialize_model(stored, newest),
        BY_TYPE, "date", EXOG, HORIZON,
    )
    return present(inference.forecast(ready, BY_TYPE, VALUE))


@query
def sarimax_residuals(spark, sf_dir):
    return present(models.residuals(_trained(spark, sf_dir, BY_TYPE), BY_TYPE), 4)


@query
def auto_arima(spark, sf_dir):
    series = daily.series_rows(daily_events(spark, sf_dir, *BY_TYPE), BY_TYPE, "date", VALUE, EXOG)
    best = models.fit_auto_arima(series, BY_TYPE)
    return present(best.select(*BY_TYPE, "n_obs", "n_fitted", F.array_join("order", ",").alias("order"), "aic"), 4)


@query
def order_search(spark, sf_dir):
    """Least AIC among three orders that SQL can fit, all scored on the same days."""
    series = daily.series_rows(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE)
    none = (0, 0, 0, 0)
    best = models.fit_auto_arima(series, BY_USER, [((1, 0, 0), none), ((1, 1, 0), none), ((0, 1, 0), none)])
    return present(
        best.select(*BY_USER, "n_obs", "n_fitted", "n_eff", F.array_join("order", ",").alias("order"), "aic"), 5
    )


# registry and inference


@query
def model_regressor_join(spark, sf_dir):
    days = daily_events(spark, sf_dir, *BY_USER)
    recent = daily.last_rows(days, HORIZON, BY_USER).select(*BY_USER, "horizon_step", *EXOG)
    fits = models.ar1_baseline(days, BY_USER, "date", VALUE).select(*BY_USER, "n_obs", "phi", "last_value")
    return present(inference.join_models(recent, fits, BY_USER))


def _registered(spark, sf_dir):
    stored = kept(registry.serialize_model(_trained(spark, sf_dir), BY_USER, "run"))
    rows = registry.registry_rows(
        stored, BY_USER, model_name="value_per_day", model_version="v1", target_series="daily_events",
        store_table="models", created=datetime(2024, 1, 1, tzinfo=timezone.utc), min_aic_improvement=1.0,
    )
    return stored, rows


@query
def model_registry(spark, sf_dir):
    _, rows = _registered(spark, sf_dir)
    text = registry.as_text_layout(rows.withColumn("metrics", F.transform_values("metrics", lambda _, v: F.round(v, 3))), BY_USER)
    parts = {k: F.get_json_object("metrics_json", f"$.{k}").cast("double") for k in ("train_aic_baseline", "train_aic_sarimax", "aic_gain")}
    return present(text.withColumns(parts).drop("metrics_json"), 2)


@query
def sarimax_forecast(spark, sf_dir):
    """Newest registered model of every series, continued by its recent regressors."""
    stored, rows = _registered(spark, sf_dir)
    newest = registry.latest_models(rows, BY_USER).select(
        *BY_USER, "run_id", "model_id", "order", "seasonal_order"
    )
    ready = inference.recent_regressors(
        daily_events(spark, sf_dir, *BY_USER), registry.deserialize_model(stored, newest),
        BY_USER, "date", EXOG, HORIZON,
    )
    return present(inference.forecast(ready, BY_USER, VALUE, ["model_id"]), 4)


# evaluation


@query
def ar1_holdout(spark, sf_dir):
    return present(
        evaluation.holdout_forecasts(
            daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, model="ar1"
        )
    )


@query
def ar1_holdout_metrics(spark, sf_dir):
    days = evaluation.holdout_forecasts(
        daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, model="ar1"
    )
    return present(evaluation.compute_metrics(days, "actual_avg_value", "forecast_avg_value", BY_USER))


@query
def closed_form_holdout(spark, sf_dir):
    """Hold-out forecasts of a model that is a regression of differences."""
    return present(
        evaluation.holdout_forecasts(
            daily_lines(spark, sf_dir, "l_returnflag").withColumnRenamed("n_rows", "n"),
            ["l_returnflag"], "date", "avg_quantity", ["n"], (0, 1, 0), (0, 1, 0, 7),
        ), 5
    )


@query
def sarimax_holdout_metrics(spark, sf_dir):
    days = evaluation.holdout_forecasts(
        daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, EXOG
    )
    return present(evaluation.compute_metrics(days, "actual_avg_value", "forecast_avg_value", BY_USER), 4)


# diagnostics


@query
def acf(spark, sf_dir):
    return present(diagnostics.acf(daily_events(spark, sf_dir, *BY_USER), VALUE, BY_USER))


@query
def acf_one_series(spark, sf_dir):
    return present(diagnostics.acf(daily_lines(spark, sf_dir), "avg_price"))


@query
def pacf(spark, sf_dir):
    return present(diagnostics.pacf(daily_events(spark, sf_dir, *BY_USER), VALUE, BY_USER))


@query
def ljung_box(spark, sf_dir):
    return present(diagnostics.ljung_box_test(daily_events(spark, sf_dir, *BY_USER), VALUE, BY_USER))


@query
def ljung_box_of_residuals(spark, sf_dir):
    errors = models.ar1_residuals(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE)
    return present(diagnostics.ljung_box_test(errors, "residual", BY_USER))


@query
def sarimax_residual_whiteness(spark, sf_dir):
    errors = models.residuals(_trained(spark, sf_dir, BY_TYPE), BY_TYPE)
    return present(diagnostics.ljung_box_test(errors, "residual", BY_TYPE), 4)


@query
def stationarity(spark, sf_dir):
    return present(diagnostics.check_stationarity(daily_events(spark, sf_dir, *BY_USER), VALUE, BY_USER))


# boosted trees


@query
def feature_vectors(spark, sf_dir):
    rows = boosting.feature_vectors(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, EXOG)
    values = vector_to_array("features")
    names = ("avg_value_lag_1", "avg_value_lag_7", "day_of_week", "day_of_month", "month", "n_events")
    return present(
        rows.select(*BY_USER, "date", "label", *(values[i].alias(c) for i, c in enumerate(names)))
    )


@query
def boosted_split(spark, sf_dir):
    """Per user: rows to learn from and to test on, their label sums, and tests with a finite prediction."""
    rows = boosting.feature_vectors(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, EXOG)
    # trees and predictions both start from the marked rows: write them once
    marked = kept(features.train_test_split_ts(rows, BY_USER, "date", train_fraction=JobConfig().gbt_train_split))
    train = marked.filter("split = 'train'").select(*rows.columns)
    test = boosting.fit_gbt(train).transform(marked.filter("split = 'test'"))
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    part = lambda df, name, *more: df.groupBy(*BY_USER).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.sum("label").alias(f"{name}_labels"), *more)
    counts = part(train, "train").join(part(test, "test", F.count_if(finite).alias("n_finite")), list(BY_USER), "full")
    return present(counts)


@query
def scoring_log(spark, sf_dir):
    """Series that each of two model names continues, counted from the forecasts."""
    days = daily_events(spark, sf_dir, *BY_TYPE)
    ends = days.groupBy(*BY_TYPE).agg(F.max("date").alias("train_end"))
    names = F.explode(F.array(F.lit("even"), F.lit("odd")))
    both = ends.withColumn("model_name", names).withColumn("model_version", F.lit("v1"))
    ready = inference.recent_regressors(days, both, BY_TYPE, "date", EXOG, HORIZON)
    rows = inference.scoring_log_rows(
        ready, scoring_run_id="r", registry_table="a", predictions_table="b",
        scoring_time=datetime(2024, 1, 1, tzinfo=timezone.utc), horizon=HORIZON,
    )
    return rows.select("model_name", "model_version", "forecast_horizon", "n_series")


@query
def boosted_trees(spark, sf_dir):
    """One model for the series of all users, tested on the newest fifth of each."""
    rows = boosting.feature_vectors(daily_events(spark, sf_dir, *BY_USER), BY_USER, "date", VALUE, EXOG)
    train, test = boosting.split_vectors(rows, BY_USER, "date", JobConfig().gbt_train_split)
    predicted = boosting.fit_gbt(train).transform(test)
    return predicted.select(*BY_USER, "date", "label", "prediction")
