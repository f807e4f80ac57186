"""Forecasts from registered models: recent regressors meet models on the series key."""
from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .daily import SERIES, complete_cases
from .models import forecast_sarimax, regressors


def join_models(rows: DataFrame, models: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    """Give every row the columns of its series' model; a null key is a key like any other.

    An equi-join whose strategy is left to adaptive execution, which knows the sizes.  Where ``SERIES`` is among
    the keys it says all, and tables bucketed by it meet without an exchange.
    """
    if SERIES in series_keys:
        return rows.join(models.drop(*(k for k in series_keys if k != SERIES)), SERIES)
    if not series_keys:
        raise ValueError("a join without series keys would be a product of both sides")
    named = {k: f"_model_{k}" for k in series_keys}
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(other)) for k, other in named.items()))
    return rows.join(models.withColumnsRenamed(named), same).drop(*named.values())


def recent_regressors(
    daily: DataFrame,
    models: DataFrame,
    series_keys: Sequence[str],
    date_col: str,
    exog: Sequence[str],
    horizon: int,
) -> DataFrame:
    """One row per model with ``future``, the regressors of the last days it was trained on.

    The newest ``horizon`` days up to the model's ``train_end`` on which no regressor is
    missing stand in for the days to come; a short series gives fewer ``steps``.

    Days meet the ends of training in ``join_models`` and are cut to the newest ones before anything
    is gathered; what a model holds joins at the end.  A null key is a key like any other.  A series may
    have several models, one for each model name.
    """
    values = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(exog)]
    held = [c for c in models.columns if c not in series_keys]
    days = complete_cases(daily, list(exog), date_col).select(*series_keys, F.col(date_col).alias("date"), *values)
    if not series_keys:
        return _recent_of_one(days, models, len(exog), horizon)
    named = models.withColumn("_model", F.sha2(F.to_json(F.struct(*models.columns)), 256))
    ends = named.select(*series_keys, "_model", "train_end").distinct()
    seen = join_models(days, ends, series_keys).where(F.col("date") <= F.col("train_end"))
    # only the newest rows of each model pass the sort's partial limit
    by = [SERIES, "_model"] if SERIES in series_keys else ["_model"]
    newest = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("date").desc()))
    last = seen.withColumn("_age", newest).where(F.col("_age") <= horizon)
    day = F.struct("date", *(f"x{i}" for i in range(len(exog))))
    gathered = last.groupBy(*by).agg(F.sort_array(F.collect_list(day)).alias("_days"))
    known = named.join(gathered, by, "left").withColumn("_days", F.coalesce("_days", F.array().cast(gathered.schema["_days"].dataType)))
    return known.select(*series_keys, *held, regressors("_days", len(exog)).alias("future"), F.size("_days").alias("steps"))


def _recent_of_one(days: DataFrame, models: DataFrame, n_exog: int, horizon: int) -> DataFrame:
    """The same for one series without keys: a join would be a product, so days and models meet in one aggregate."""
    names = ["date", *(f"x{i}" for i in range(n_exog))]
    rows = days.select(F.struct(*names).alias("_day")).unionByName(
        models.select(F.struct(*models.columns).alias("_model")), allowMissingColumns=True
    )
    gathered = rows.agg(F.collect_list("_model").alias("_models"), F.sort_array(F.collect_list("_day")).alias("_days"))
    known = gathered.select(F.explode("_models").alias("_model"), "_days").select("_model.*", "_days")
    seen = F.filter("_days", lambda d: d["date"] <= F.col("train_end"))
    recent = known.withColumn("_seen", seen).withColumn(
        "_days", F.slice("_seen", F.greatest(F.size("_seen") - horizon + 1, F.lit(1)), F.lit(horizon))
    )
    return recent.select(*models.columns, regressors("_days", n_exog).alias("future"), F.size("_days").alias("steps"))


def forecast(
    df: DataFrame, series_keys: Sequence[str], target: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Rows (horizon_step, forecast_<target>) for rows of ``recent_regressors``."""
    values = forecast_sarimax("", F.col("future"), F.col("steps"))
    steps = df.select(*series_keys, *extra, F.posexplode(values).alias("_step", "_value"))
    return steps.select(
        *series_keys, *extra,
        (F.col("_step") + 1).cast("bigint").alias("horizon_step"),
        F.col("_value").alias(f"forecast_{target}"),
    )


def scoring_log_rows(
    scored: DataFrame,
    *,
    scoring_run_id: str,
    registry_table: str,
    predictions_table: str,
    scoring_time: datetime,
    horizon: int,
) -> DataFrame:
    """One row per model name and version used in a scoring run."""
    return scored.groupBy("model_name", "model_version").agg(F.count(F.lit(1)).alias("n_series")).select(
        F.lit(scoring_run_id).alias("scoring_run_id"),
        "model_name",
        "model_version",
        F.lit(registry_table).alias("registry_table"),
        F.lit(predictions_table).alias("predictions_table"),
        F.lit(scoring_time).cast("timestamp").alias("scoring_time"),
        F.lit(horizon).cast("bigint").alias("forecast_horizon"),
        "n_series",
    )
