"""Features of daily series: calendar, lags, rolling windows, splits.

Windows partition by series and order by date, so one exchange serves them all. One series without keys is
numbered and lagged by blocks of its days (``daily.numbered``, ``daily.with_lags``), so no task holds all of it.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .daily import by_date, numbered, with_lags


def parse_datetime_index(
    df: DataFrame,
    column: str,
    series_keys: Sequence[str] = (),
    fmt: str | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Turn a text or timestamp column into a date column and drop rows that are no date.

    Unless ``check_unique`` is off, the result fails when it is computed if a series has two
    rows for one date.
    """
    if fmt is not None:
        parsed = F.try_to_timestamp(F.col(column), F.lit(fmt))
    else:
        parsed = F.col(column).try_cast("timestamp")
    dated = df.withColumn(column, F.to_date(parsed)).filter(F.col(column).isNotNull())
    if not check_unique:
        return dated
    rows = F.count(F.lit(1)).over(Window.partitionBy(*series_keys, column))
    refuse = F.raise_error(F.lit(f"more than one row per series and {column}")).cast("boolean")
    return dated.withColumn("_rows", rows).filter(F.when(F.col("_rows") == 1, True).otherwise(refuse)).drop("_rows")


def duplicate_dates(df: DataFrame, date_col: str, series_keys: Sequence[str] = ()) -> DataFrame:
    return (
        df.groupBy(*series_keys, date_col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def add_calendar_features(df: DataFrame, column: str = "date") -> DataFrame:
    """Day of week (Sunday = 1), day of month, ISO week, month, quarter, weekend flag.

    A timestamp column also gives the hour.
    """
    kind = df.schema[column].dataType.typeName()
    parts = {
        "day_of_week": F.dayofweek(column),
        "day_of_month": F.dayofmonth(column),
        "week_of_year": F.weekofyear(column),
        "month": F.month(column),
        "quarter": F.quarter(column),
        "is_weekend": F.dayofweek(column).isin(1, 7),
    }
    if kind.startswith("timestamp"):
        parts["hour"] = F.hour(column)
    return df.withColumns(parts)


def add_lag_features(
    df: DataFrame,
    column: str,
    lags: Sequence[int],
    series_keys: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    if not series_keys:
        found = with_lags(numbered(df, date_col, "_t", "_n"), {f"{column}_lag_{k}": (column, k) for k in lags}, "_t")
        return found.drop("_t", "_n")
    window = by_date(series_keys, date_col)
    return df.withColumns({f"{column}_lag_{k}": F.lag(column, k).over(window) for k in lags})


def add_rolling_features(
    df: DataFrame,
    column: str,
    windows: Sequence[int],
    series_keys: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """Mean, sample deviation, least and greatest of the k rows before the current one."""
    added: dict[str, Column] = {}
    for k in windows:
        before = by_date(series_keys, date_col).rowsBetween(-k, -1)
        added |= {
            f"{column}_mean_{k}": F.avg(column).over(before),
            f"{column}_std_{k}": F.stddev_samp(column).over(before),
            f"{column}_min_{k}": F.min(column).over(before),
            f"{column}_max_{k}": F.max(column).over(before),
        }
    return df.withColumns(added)


# Fixed value: the longest hold-out in days.
MAX_HOLDOUT = 7


def holdout_length(n_obs: Column) -> Column:
    """A fifth of the series, at least 1 day and at most 7."""
    return F.least(F.lit(MAX_HOLDOUT), F.greatest(F.lit(1), F.floor(n_obs / 5))).cast("int")


def train_test_split_ts(
    df: DataFrame,
    series_keys: Sequence[str] = (),
    date_col: str = "date",
    test_size: int | None = None,
    train_fraction: float | None = None,
) -> DataFrame:
    """Mark each row ``train`` or ``test``: the test rows are the newest of their series.

    Their number is ``test_size``, or what ``train_fraction`` leaves over, or
    ``holdout_length`` if neither is given.
    """
    if test_size is not None and train_fraction is not None:
        raise ValueError("give test_size or train_fraction, not both")
    if test_size is not None:
        held = F.lit(test_size)
    elif train_fraction is not None:
        held = F.col("n_obs") - F.floor(F.col("n_obs") * train_fraction)
    else:
        held = holdout_length(F.col("n_obs"))
    if series_keys:
        n_obs = F.count(F.lit(1)).over(Window.partitionBy(*series_keys))
        rows = df.withColumn("t", F.row_number().over(by_date(series_keys, date_col))).withColumn("n_obs", n_obs)
    else:
        rows = numbered(df, date_col)
    return rows.withColumn("split", F.when(F.col("t") > F.col("n_obs") - held, "test").otherwise("train"))
