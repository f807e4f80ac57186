"""Autocorrelation, partial autocorrelation, whiteness and unit-root checks per series.

One exchange by series serves a whole table of series: lagged columns come from one window,
sums from one aggregate, and everything after that is arithmetic on a short array.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    NORMAL_975,
    autocorrelation_bands,
    chi2_tail,
    ljung_box,
    partial_autocorrelations,
)
from .daily import by_date, complete_cases, numbered, with_lags

MAX_LAG = 20
# Fixed value: large-sample 5 % point of the Dickey-Fuller t statistic with a constant.
DICKEY_FULLER_5PCT = -2.86


def autocorrelations(
    df: DataFrame,
    value: str,
    series_keys: Sequence[str] = (),
    date_col: str = "date",
    max_lag: int = MAX_LAG,
) -> DataFrame:
    """One row per series: ``n_obs`` and ``acf``, lags 0..min(max_lag, n-1).

    Correlations of a constant series are null.
    """
    ready = complete_cases(df, [value], date_col).select(*series_keys, date_col, F.col(value).alias("_v"))
    if not series_keys:
        return _correlations_of_one(ready, date_col, max_lag)
    ordered = by_date(series_keys, date_col)
    centred = ready.withColumn("_c", F.col("_v") - F.avg("_v").over(Window.partitionBy(*series_keys)))
    lagged = centred.withColumns(
        {f"_c{k}": F.lag("_c", k).over(ordered) for k in range(1, max_lag + 1)}
    )
    return _ratios(lagged, series_keys, max_lag)


def _correlations_of_one(ready: DataFrame, date_col: str, max_lag: int) -> DataFrame:
    """The same for one series: its days are centred and lagged in blocks."""
    mean = ready.agg(F.avg("_v").alias("_mean"))
    rows = numbered(ready, date_col, "_t", "_n").withColumn("_c", F.col("_v") - mean.scalar())
    return _ratios(with_lags(rows, {f"_c{k}": ("_c", k) for k in range(1, max_lag + 1)}, "_t"), (), max_lag)


def _ratios(lagged: DataFrame, series_keys: Sequence[str], max_lag: int) -> DataFrame:
    products = [F.sum(F.col("_c") * F.col(f"_c{k}" if k else "_c")) for k in range(max_lag + 1)]
    sums = lagged.groupBy(*series_keys).agg(
        F.count(F.lit(1)).alias("n_obs"), F.array(*products).alias("_s")
    )
    # a global aggregate gives a row even without input
    sums = sums.filter(F.col("n_obs") > 0)
    kept = F.slice("_s", F.lit(1), F.least(F.lit(max_lag + 1), F.col("n_obs")).cast("int"))
    acf = F.transform(kept, lambda s: F.try_divide(s, F.col("_s")[0]))
    return sums.select(*series_keys, "n_obs", acf.alias("acf"))


def acf(
    df: DataFrame,
    value: str,
    series_keys: Sequence[str] = (),
    date_col: str = "date",
    max_lag: int = MAX_LAG,
) -> DataFrame:
    """Rows (lag, acf, band) from lag 0, with the half-width of the 95 % band."""
    series = autocorrelations(df, value, series_keys, date_col, max_lag)
    both = F.arrays_zip(
        F.col("acf"), autocorrelation_bands(F.col("acf"), F.col("n_obs")).alias("band")
    )
    rows = series.select(*series_keys, "n_obs", F.posexplode(both).alias("lag", "_r"))
    return rows.select(*series_keys, "n_obs", "lag", F.col("_r.acf").alias("acf"), F.col("_r.band").alias("band"))


def pacf_lags(n_obs: Column, max_lag: int = MAX_LAG) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(max_lag), F.floor(n_obs / 2) - 1)).cast("int")


def pacf(
    df: DataFrame,
    value: str,
    series_keys: Sequence[str] = (),
    date_col: str = "date",
    max_lag: int = MAX_LAG,
) -> DataFrame:
    """Rows (lag, pacf, band) for lags 1..max(1, min(max_lag, n/2 - 1))."""
    series = autocorrelations(df, value, series_keys, date_col, max_lag)
    partial = partial_autocorrelations(F.col("acf"), pacf_lags(F.col("n_obs"), max_lag))
    rows = series.select(*series_keys, "n_obs", F.posexplode(partial).alias("_k", "pacf"))
    return rows.select(
        *series_keys, "n_obs", (F.col("_k") + 1).alias("lag"), "pacf",
        (NORMAL_975 / F.sqrt("n_obs")).alias("band"),
    )


def ljung_box_test(
    df: DataFrame,
    value: str,
    series_keys: Sequence[str] = (),
    date_col: str = "date",
    max_lag: int = MAX_LAG,
) -> DataFrame:
    """Rows (lag, q, p_value) at lags min(10, m) and m, where m = max(1, min(max_lag, n-1))."""
    series = autocorrelations(df, value, series_keys, date_col, max_lag)
    longest = F.greatest(F.lit(1), F.least(F.lit(max_lag), F.col("n_obs") - 1)).cast("int")
    lags = F.array_distinct(F.array(F.least(F.lit(10), longest), longest))
    rows = series.withColumn("lag", F.explode(lags))
    rows = rows.withColumn("q", ljung_box(F.col("acf"), F.col("n_obs"), F.col("lag")))
    return rows.select(*series_keys, "n_obs", "lag", "q", chi2_tail(F.col("q"), F.col("lag")).alias("p_value"))


def check_stationarity(
    df: DataFrame, value: str, series_keys: Sequence[str] = (), date_col: str = "date"
) -> DataFrame:
    """Dickey-Fuller regression with a constant and no lags; stationary at 5 % if t < -2.86."""
    ready = complete_cases(df, [value], date_col)
    if series_keys:
        pairs = ready.withColumn("_prev", F.lag(value).over(by_date(series_keys, date_col)))
    else:
        pairs = with_lags(numbered(ready, date_col, "_t", "_n"), {"_prev": (value, 1)}, "_t")
    change = F.col(value) - F.col("_prev")
    sums = (
        pairs.withColumn("_change", change)
        .groupBy(*series_keys)
        .agg(
            F.regr_count("_change", "_prev").alias("n_pairs"),
            F.regr_slope("_change", "_prev").alias("gamma"),
            F.regr_sxx("_change", "_prev").alias("_sxx"),
            F.regr_sxy("_change", "_prev").alias("_sxy"),
            F.regr_syy("_change", "_prev").alias("_syy"),
        )
    )
    variance = F.try_divide(F.col("_syy") - F.col("gamma") * F.col("_sxy"), F.col("n_pairs") - 2)
    t = F.try_divide(F.col("gamma"), F.sqrt(F.try_divide(variance, F.col("_sxx"))))
    return sums.select(*series_keys, "n_pairs", "gamma", t.alias("t_stat")).withColumn(
        "stationary", F.col("t_stat") < DICKEY_FULLER_5PCT
    )
