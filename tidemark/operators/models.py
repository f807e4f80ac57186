"""Fitting: a closed-form baseline and a seasonal model with regressors, per series.

Both are sums and small linear systems in column expressions (``functions.arma``), so no row leaves the JVM.
Rows stay where the exchange by series put them: baseline, fit and gate share that one exchange.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Order, SeasonalOrder
from ..functions import arma
from ..functions.arma import Shape
from ..functions.columns import continue_series, gaussian_aic, regression_part
from .daily import by_date, complete_cases, numbered, spread_by_series, with_lags

#: Days from which the seasonal order is used, unless a job says otherwise.
SEASONAL_FROM = 30
#: Days from which shocks come from a deeper autoregression, and by how many seasons more.
DEEP_FROM, DEEP = 150, 1
SHORT_ORDER: Order = (1, 1, 1)
SHORT_SEASONAL: SeasonalOrder = (0, 0, 0, 0)

def int_array(values: Sequence[int]) -> Column:
    return F.array(*(F.lit(int(v)) for v in values))


def choose_order(
    n_obs: Column,
    order: Order = (1, 1, 1),
    seasonal: SeasonalOrder = (1, 1, 1, 7),
    seasonal_from: int = SEASONAL_FROM,
) -> tuple[Column, Column]:
    """The stated orders from ``seasonal_from`` days on, (1,1,1)(0,0,0,0) below."""
    enough = n_obs >= seasonal_from
    return (
        F.when(enough, int_array(order)).otherwise(int_array(SHORT_ORDER)),
        F.when(enough, int_array(seasonal)).otherwise(int_array(SHORT_SEASONAL)),
    )


def fit_series(
    df: DataFrame,
    y: str,
    x: str,
    n_exog: int,
    n_obs: Column,
    ready: Column,
    order: Order = (1, 1, 1),
    seasonal: SeasonalOrder = (1, 1, 1, 7),
    seasonal_from: int = SEASONAL_FROM,
) -> DataFrame:
    """Add ``_fit``, the model of ``arma.fit`` in the orders that ``choose_order`` gives, where ``ready``."""
    choices = [
        (ready & (n_obs < seasonal_from), Shape.of(SHORT_ORDER, SHORT_SEASONAL)),
        (ready & (n_obs < DEEP_FROM), Shape.of(order, seasonal)),
        (ready, Shape.of(order, seasonal, DEEP)),
    ]
    return arma.fit(df, y, x, n_exog, choices)


def forecast_sarimax(model: str, future: Column, steps: Column) -> Column:
    """Array of forecasts by the model in the columns ``<model>params`` etc.; null without one.

    ``future`` holds one array of ``steps`` values for each regressor.
    """
    params = F.col(f"{model}params")
    carried = continue_series(
        F.col(f"{model}recursion"), F.col(f"{model}recent"), F.col(f"{model}shocks"), steps
    )
    values = F.zip_with(carried, regression_part(params, future, steps), lambda z, b: z + b)
    return F.when(params.isNotNull() & (steps > 0), values)


def _lagged_pairs(
    df: DataFrame, series_keys: Sequence[str], date_col: str, target: str, burn: Column | None = None
) -> DataFrame:
    """Add ``_prev`` (yesterday's target, where it is to count) and ``_phi`` (their regression)."""
    if not series_keys:
        return _lagged_pairs_of_one(df, date_col, target, burn)
    whole = Window.partitionBy(*series_keys)
    ordered = by_date(series_keys, date_col)
    prev = F.lag(target).over(ordered)
    if burn is not None:
        n_obs = F.count(F.lit(1)).over(whole)
        df = df.withColumn("_n", n_obs)
        prev = F.when(F.row_number().over(ordered) > burn, prev)
    df = df.withColumn("_prev", prev)
    phi = F.try_divide(
        F.sum(F.col(target) * F.col("_prev")).over(whole),
        F.sum(F.col("_prev") * F.col("_prev")).over(whole),
    )
    return df.withColumn("_phi", phi)


def _lagged_pairs_of_one(df: DataFrame, date_col: str, target: str, burn: Column | None) -> DataFrame:
    """The same for one series without keys, in blocks of its days."""
    rows = with_lags(numbered(df, date_col, "_t", "_n"), {"_prev": (target, 1)}, "_t")
    if burn is not None:
        rows = rows.withColumn("_prev", F.when(F.col("_t") > burn, F.col("_prev")))
    pairs = rows.agg(F.try_divide(F.sum(F.col(target) * F.col("_prev")), F.sum(F.col("_prev") * F.col("_prev"))).alias("_phi"))
    return rows.drop("_t").withColumn("_phi", pairs.scalar())


def _ar1_sums(target: str) -> list[Column]:
    miss = F.col(target) - F.col("_phi") * F.col("_prev")
    return [
        F.count(F.lit(1)).alias("n_obs"),
        F.count("_prev").alias("n_eff"),
        F.first("_phi").alias("phi"),
        F.sum(miss * miss).alias("_sse"),
    ]


def _ar1_columns() -> dict[str, Column]:
    sigma2 = F.try_divide(F.col("_sse"), F.col("n_eff"))
    return {"sigma2": sigma2, "aic": gaussian_aic(F.col("n_eff"), sigma2, 2)}


def ar1_baseline(
    df: DataFrame, series_keys: Sequence[str], date_col: str, target: str
) -> DataFrame:
    """(1,0,0) without constant: coefficient, shock variance and AIC per series.

    With a diffuse start the likelihood of this model is that of the lagged pairs, so the
    greatest-likelihood fit is a regression through the origin.
    """
    ready = _lagged_pairs(complete_cases(df, [target], date_col), series_keys, date_col, target)
    return (
        ready.groupBy(*series_keys)
        .agg(*_ar1_sums(target), F.max_by(target, date_col).alias("last_value"))
        .withColumns(_ar1_columns())
        .drop("_sse")
    )


def ar1_residuals(
    df: DataFrame, series_keys: Sequence[str], date_col: str, target: str
) -> DataFrame:
    """One-step errors of the baseline; the first day is expected to be zero (``burn_in``)."""
    ready = _lagged_pairs(complete_cases(df, [target], date_col), series_keys, date_col, target)
    expected = F.when(F.col("_prev").isNull(), 0.0).otherwise(F.col("_phi") * F.col("_prev"))
    return ready.select(
        *series_keys, date_col,
        (F.col(target) - expected).alias("residual"),
        F.col("_prev").isNull().alias("burn_in"),
    )


def ar1_forecast(phi: Column, last: Column, horizon: int) -> Column:
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return F.transform(steps, lambda h: F.pow(phi, h) * last)


def train(
    df: DataFrame,
    series_keys: Sequence[str],
    date_col: str,
    target: str,
    exog: Sequence[str],
    order: Order = (1, 1, 1),
    seasonal: SeasonalOrder = (1, 1, 1, 7),
    min_observations: int = 10,
    aic_basis: str = "own",
    partitions: int | None = None,
    seasonal_from: int = SEASONAL_FROM,
    spread: bool = True,
) -> DataFrame:
    """One model row per series: orders, parameters, both AICs, tail state, residuals, status.

    ``aic_basis="common"`` scores baseline and candidate on the same days; ``"own"`` leaves
    each the days its own states allow.  Status is ``fitted``, ``failed`` (no finite AIC, or no
    more days to score than parameters) or ``too_short``.  Without ``spread``, rows stay where the table has them.
    """
    burns = [max(Shape.of(o, s).k_states, 1) for o, s in ((order, seasonal), (SHORT_ORDER, SHORT_SEASONAL))]
    shared = F.when(F.col("_n") >= seasonal_from, burns[0]).otherwise(burns[1])
    ready = complete_cases(df, [target, *exog], date_col)
    if spread:
        ready = spread_by_series(ready, series_keys, partitions)
    pairs = _lagged_pairs(
        ready, series_keys, date_col, target, shared if aic_basis == "common" else None
    )
    day = F.struct(
        F.col(date_col).alias("date"),
        F.col(target).cast("double").alias("y"),
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(exog)),
    )
    series = pairs.groupBy(*series_keys).agg(
        *_ar1_sums(target), F.sort_array(F.collect_list(day)).alias("_days")
    )
    baseline = series.withColumns(_ar1_columns()).select(
        *series_keys,
        "n_obs",
        F.col("_days.date").alias("dates"),
        F.col("_days.y").alias("_y"),
        regressors("_days", len(exog)).alias("_x"),
        F.struct("phi", "sigma2", "aic", "n_eff").alias("baseline"),
    )
    chosen, chosen_seasonal = choose_order(F.col("n_obs"), order, seasonal, seasonal_from)
    ready_to_fit = F.col("n_obs") >= min_observations
    days_left_out = F.when(F.col("n_obs") >= seasonal_from, burns[0]).otherwise(burns[1])
    chosen_rows = baseline.withColumns({"order": chosen, "seasonal_order": chosen_seasonal})
    fitted = (
        fit_series(chosen_rows, "_y", "_x", len(exog), F.col("n_obs"), ready_to_fit, order, seasonal, seasonal_from)
        .select(
            *series_keys,
            "n_obs",
            F.get("dates", F.lit(0)).alias("train_start"),
            F.element_at("dates", -1).alias("train_end"),
            "order",
            "seasonal_order",
            F.array(*(F.lit(c) for c in exog)).cast("array<string>").alias("exog_columns"),
            "_fit.*",
            "baseline",
            "dates",
        )
        .withColumn("n_eff", F.coalesce("n_eff", F.greatest(F.col("n_obs") - days_left_out, F.lit(0))))
    )
    gain = F.col("baseline.aic") - F.col("aic")
    status = (
        F.when(~ready_to_fit, "too_short")
        .when(gain.isNull() | F.isnan(gain) | ~F.coalesce("converged", F.lit(False)), "failed")
        .otherwise("fitted")
    )
    return fitted.withColumns({"aic_gain": gain, "status": status})


def regressors(days: str, count: int) -> Column:
    """One array per regressor out of an array of day structs."""
    if not count:
        return F.array().cast("array<array<double>>")
    return F.array(*(F.col(f"{days}.x{i}") for i in range(count)))


def residuals(models: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    """One-step errors of fitted models by date; the first ``k_states`` days are ``burn_in``.

    Days that have fewer days before them than the model looks back on have no error (null).
    """
    rows = models.filter(F.col("status") == "fitted").select(
        *series_keys,
        F.col("burn_in").alias("_burn"),
        F.posexplode(F.arrays_zip("dates", "resid")).alias("_pos", "_day"),
    )
    return rows.select(
        *series_keys,
        F.col("_day.dates").alias("date"),
        F.col("_day.resid").alias("residual"),
        (F.col("_pos") < F.col("_burn")).alias("burn_in"),
    )


def passes_gate(min_aic_improvement: float) -> Column:
    """A fitted candidate whose AIC lies far enough below the baseline's."""
    return (F.col("status") == "fitted") & (F.col("aic_gain") >= min_aic_improvement)


# The orders searched when none are given.
SEARCH_ORDERS: tuple[tuple[Order, SeasonalOrder], ...] = tuple(
    ((p, 1, q), (0, 0, 0, 0)) for p in range(3) for q in range(3)
)


def search_orders(
    series: DataFrame,
    series_keys: Sequence[str],
    candidates: Sequence[tuple[Order, SeasonalOrder]] = SEARCH_ORDERS,
    n_exog: int | None = None,
) -> DataFrame:
    """Every candidate order for every series of ``series_rows``: one row for each pair.

    All candidates of a search are scored on the same days, and those with the same differences come from
    one matrix of moments per series. ``n_exog`` is the number of regressors in ``x``; if it is not given, it is
    read from the plan's column list, which ``series_rows`` leaves there. ``train`` fits the order that is chosen.
    """
    count = series.schema["x"].metadata.get("count", 0) if n_exog is None else n_exog
    shapes = [Shape.of(o, s) for o, s in candidates]
    tried = arma.search(series, "y", "x", count, shapes)
    orders = F.array(
        *(F.struct(int_array(o).alias("order"), int_array(s).alias("seasonal_order")) for o, s in candidates)
    )
    both = tried.select(
        *series_keys, "n_obs", F.explode(F.arrays_zip(orders.alias("o"), F.col("_tried").alias("f"))).alias("_one")
    )
    return both.select(*series_keys, "n_obs", "_one.o.*", "_one.f.*")


def fit_auto_arima(
    series: DataFrame,
    series_keys: Sequence[str],
    candidates: Sequence[tuple[Order, SeasonalOrder]] = SEARCH_ORDERS,
    n_exog: int | None = None,
) -> DataFrame:
    """The candidate of least AIC for every series; fewer parameters win a tie."""
    tried = search_orders(series, series_keys, candidates, n_exog)
    rank = F.when(
        F.col("aic").isNotNull() & F.col("converged"),
        F.struct("aic", F.size("params"), F.col("order"), F.col("seasonal_order")),
    )
    chosen = [c for c in tried.columns if c not in (*series_keys, "n_obs")]
    best = tried.groupBy(*series_keys).agg(
        F.first("n_obs").alias("n_obs"),
        F.count("aic").alias("n_fitted"),
        F.min_by(F.struct(*chosen), rank).alias("_best"),
    )
    return best.select(*series_keys, "n_obs", "n_fitted", "_best.*")
