"""Hold-out evaluation: refit on the head of every series, forecast its tail, measure."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Order, SeasonalOrder
from .daily import length_status, series_rows
from .features import MAX_HOLDOUT, holdout_length
from .models import SEASONAL_FROM, ar1_forecast, fit_series, forecast_sarimax


def compute_metrics(
    df: DataFrame, actual: str, forecast: str, series_keys: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute and root mean square error per series over rows that have both values."""
    miss = F.col(actual) - F.col(forecast)
    return df.groupBy(*series_keys).agg(
        F.count(miss).alias("n"),
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
    )


def split_series(series: DataFrame, series_keys: Sequence[str], min_observations: int) -> DataFrame:
    """Cut the arrays of ``series_rows`` into a training head and a test tail."""
    held = holdout_length(F.col("n_obs"))
    kept = (F.col("n_obs") - held).cast("int")

    def head(c: str | Column) -> Column:
        return F.slice(c, F.lit(1), kept)

    def tail(c: str | Column) -> Column:
        return F.slice(c, kept + 1, held)

    return series.select(
        *series_keys,
        kept.cast("bigint").alias("n_train"),
        length_status(kept, min_observations).alias("status"),
        head("y").alias("y"),
        F.transform("x", head).alias("x"),
        tail("dates").alias("dates"),
        tail("y").alias("actual"),
        F.transform("x", tail).alias("future"),
    )


def holdout_forecasts(
    df: DataFrame,
    series_keys: Sequence[str],
    date_col: str,
    target: str,
    exog: Sequence[str] = (),
    order: Order = (1, 1, 1),
    seasonal: SeasonalOrder = (1, 1, 1, 7),
    min_observations: int = 10,
    model: str = "sarimax",
    partitions: int | None = None,
    seasonal_from: int = SEASONAL_FROM,
) -> DataFrame:
    """Rows (date, actual_<target>, forecast_<target>, status) of the held-out days.

    ``model`` is ``"sarimax"`` or ``"ar1"``, the baseline.  The orders follow the length of the
    training part as in ``train``.  The forecast is null where the training part is too short
    or the fit failed (no days left to score), and the status says so.
    """
    series = series_rows(df, series_keys, date_col, target, exog, partitions)
    parts = split_series(series, series_keys, min_observations)
    enough = F.col("status") == "ok"
    if model == "ar1":
        forecast = F.when(enough, ar1_forecast(F.col("_phi"), F.try_element_at("y", F.lit(-1)), MAX_HOLDOUT))
        done = parts.withColumn("_phi", _ar1_slope("y")).withColumn("forecast", forecast)
    elif model == "sarimax":
        fitted = fit_series(parts, "y", "x", len(exog), F.col("n_train"), enough, order, seasonal, seasonal_from)
        done = fitted.withColumn(
            "forecast", forecast_sarimax("_fit.", F.col("future"), F.size("actual"))
        ).withColumn(
            "status", F.when(enough & F.col("forecast").isNull(), "failed").otherwise(F.col("status"))
        )
    else:
        raise ValueError("model must be 'sarimax' or 'ar1'")
    forecast_by_day = F.coalesce(
        F.slice("forecast", F.lit(1), F.size("actual")),
        F.transform("actual", lambda _: F.lit(None).cast("double")),
    )
    days = F.arrays_zip("dates", "actual", forecast_by_day.alias("forecast"))
    return done.select(*series_keys, "status", F.inline(days)).select(
        *series_keys,
        F.col("dates").alias("date"),
        F.col("actual").alias(f"actual_{target}"),
        F.col("forecast").alias(f"forecast_{target}"),
        "status",
    )


def _ar1_slope(y: str) -> Column:
    """Regression of an array on its own lag, through the origin."""
    pairs = F.zip_with(
        F.slice(y, F.lit(1), F.greatest(F.size(y) - 1, F.lit(0))),
        F.slice(y, F.lit(2), F.greatest(F.size(y) - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    zero = F.struct(F.lit(0.0).alias("ab"), F.lit(0.0).alias("aa"))
    return F.aggregate(
        pairs,
        zero,
        lambda s, p: F.struct(
            (s["ab"] + p["a"] * p["b"]).alias("ab"), (s["aa"] + p["a"] * p["a"]).alias("aa")
        ),
        lambda s: F.try_divide(s["ab"], s["aa"]),
    )
