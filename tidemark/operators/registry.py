"""Model store, registry, and run log: append-only tables keyed by model and series.

The store holds every fit under a model id of its own; the registry lists the fits that
passed the gate.  A rejected fit therefore never replaces anything.
"""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .daily import SERIES
from .models import passes_gate


def series_id(series_keys: Sequence[str]) -> Column:
    """A text that names the series; the same on every attempt of a task."""
    if not series_keys:
        return F.lit("all")
    return F.sha2(F.to_json(F.struct(*series_keys), {"ignoreNullFields": "false"}), 256)


def serialize_model(models: DataFrame, series_keys: Sequence[str], run_id: str) -> DataFrame:
    """Rows for the model store: the fit with its id and run."""
    return models.withColumns(
        {
            "model_id": F.concat_ws("-", F.lit(run_id), series_id(series_keys)),
            "run_id": F.lit(run_id),
        }
    )


def deserialize_model(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add what is needed to continue a series to the models that ``wanted`` names by run and id."""
    by = [c for c in (SERIES, "run_id", "model_id") if c in wanted.columns]
    return wanted.join(store.select(*by, *MODEL_STATE), by)


MODEL_STATE = ("params", "recursion", "recent", "shocks", "train_end")


def registry_rows(
    stored: DataFrame,
    series_keys: Sequence[str],
    *,
    model_name: str,
    model_version: str,
    target_series: str,
    store_table: str,
    created: datetime,
    min_aic_improvement: float,
) -> DataFrame:
    """Rows to append to the registry for the stored fits that pass the gate."""
    return stored.filter(passes_gate(min_aic_improvement)).select(
        *series_keys,
        "model_id",
        "run_id",
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.concat(F.lit(f"{store_table}#"), "model_id").alias("model_path"),
        F.lit("").alias("mlflow_model_uri"),
        F.lit(target_series).alias("target_series"),
        F.lit(created).cast("timestamp").alias("created_utc"),
        "order",
        "seasonal_order",
        "n_obs",
        "exog_columns",
        F.lit("Staging").alias("stage"),
        F.lit("active").alias("status"),
        F.create_map(
            F.lit("train_aic_baseline"), F.col("baseline.aic"),
            F.lit("train_aic_sarimax"), F.col("aic"),
            F.lit("aic_gain"), F.col("aic_gain"),
            F.lit("n_obs"), F.col("n_obs").cast("double"),
            F.lit("converged"), F.col("converged").cast("double"),
        ).alias("metrics"),
    )


def as_text_layout(registry: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """The registry with orders, columns, time and metrics as text, 13 columns in all."""

    def as_tuple(column: str) -> Column:
        return F.concat(F.lit("("), F.array_join(column, ", "), F.lit(")"))

    metrics = F.struct(
        *(F.col("metrics")[k].alias(k) for k in ("train_aic_baseline", "train_aic_sarimax", "aic_gain")),
        F.col("metrics")["n_obs"].cast("bigint").alias("n_obs"),
    )
    return registry.select(
        *series_keys,
        "model_name", "model_version", "model_path", "mlflow_model_uri", "target_series",
        F.date_format("created_utc", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("created_utc"),
        as_tuple("order").alias("order"),
        as_tuple("seasonal_order").alias("seasonal_order"),
        "n_obs",
        F.array_join("exog_columns", ",").alias("exog_columns"),
        "stage", "status",
        F.to_json(metrics).alias("metrics_json"),
    )


def latest_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each group by ``order``, as an aggregate: no sort, combined map-side."""
    kept = list(columns) if columns is not None else [c for c in df.columns if c not in group]
    newest = df.groupBy(*group).agg(
        F.max_by(F.struct(*kept), F.struct(*order)).alias("_newest"),
        F.count(F.lit(1)).alias("_n"),
    )
    return newest.filter(F.col("_n") > 0).select(*group, "_newest.*")


def latest_models(
    registry: DataFrame,
    series_keys: Sequence[str] = (),
    scope: str = "series",
    model_name: str | None = None,
    target_series: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest staged model of each series and model name, in all or some ``columns``.

    Inactive rows do not count and ties go to the greater model id.  ``scope="global"``
    asks for one row of the whole registry and looks at the stage alone.
    """
    staged = registry.filter(F.col("stage") == "Staging")
    if scope == "global":
        return latest_rows(staged, (), ("created_utc", "model_id"), registry.columns)
    if scope != "series":
        raise ValueError("scope must be 'series' or 'global'")
    staged = staged.filter(F.col("status") == "active")
    if model_name is not None:
        staged = staged.filter(F.col("model_name") == model_name)
    if target_series is not None:
        staged = staged.filter(F.col("target_series") == target_series)
    return latest_rows(staged, ("model_name", *series_keys), ("created_utc", "model_id"), columns)


def run_log_rows(
    models: DataFrame, run_id: str, experiment: str, params: dict[str, str], logged: datetime
) -> DataFrame:
    """Parameters of a run and its metrics over all series, one row for each.

    With one series the mean of a metric is the metric.
    """
    fitted = F.col("status") == "fitted"
    sums = models.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(fitted).alias("n_fitted"),
        F.sum("n_obs").alias("n_obs"),
        F.avg(F.when(fitted, F.col("baseline.aic"))).alias("train_aic_baseline"),
        F.avg(F.when(fitted, F.col("aic"))).alias("train_aic_sarimax"),
    )
    entries = [
        F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"), F.lit(str(v)).alias("value"))
        for k, v in params.items()
    ] + [
        F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
        for c in sums.columns
    ]
    return sums.select(F.inline(F.array(*entries))).select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.lit(logged).cast("timestamp").alias("logged_utc"),
        "kind", "key", "value",
    )
