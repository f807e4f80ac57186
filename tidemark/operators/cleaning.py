"""Quality rules on raw rows.

All of it is column expressions over one scan: nothing here shuffles, and the filter of
``positive_rows`` reaches the Parquet reader.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def all_positive(columns: Sequence[str], drop_nan: bool = False) -> Column:
    """Every column is strictly above zero.  Null fails; NaN passes unless ``drop_nan``."""
    tests = [F.col(c) > 0 for c in columns]
    if drop_nan:
        tests += [~F.isnan(c) for c in columns]
    return reduce(and_, tests, F.lit(True))


def positive_rows(df: DataFrame, columns: Sequence[str], drop_nan: bool = False) -> DataFrame:
    return df.filter(all_positive(columns, drop_nan))


def flag_to_boolean(df: DataFrame, column: str, true_value: str = "Y") -> DataFrame:
    """Only the exact value is true; null and everything else are false."""
    return df.withColumn(column, F.when(F.col(column) == true_value, True).otherwise(False))


def to_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast in place; text that is no timestamp becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in columns})


def bad_timestamp(columns: Sequence[str]) -> Column:
    """A value is present in one of the columns but is no timestamp."""
    tests = [F.col(c).isNotNull() & F.col(c).try_cast("timestamp").isNull() for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _report_columns(
    df: DataFrame, positive: Sequence[str], timestamps: Sequence[str], drop_nan: bool
) -> list[Column]:
    # coalesce: a null test is a failed test, as in a filter
    kept = F.coalesce(all_positive(positive, drop_nan), F.lit(False))
    # dates and timestamps cannot be bad, so rows are not parsed a second time for them
    doubtful = [c for c in timestamps if not df.schema[c].dataType.typeName().startswith(("timestamp", "date"))]
    return [
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(kept).alias("clean_rows"),
        F.count_if(kept & bad_timestamp(doubtful)).alias("bad_timestamps"),
    ]


def quality_report(
    df: DataFrame,
    positive: Sequence[str],
    timestamps: Sequence[str] = (),
    drop_nan: bool = False,
) -> DataFrame:
    """One row: rows before and after the rules, removed rows and their share (null if empty)."""
    removed = F.col("initial_rows") - F.col("clean_rows")
    return df.agg(*_report_columns(df, positive, timestamps, drop_nan)).select(
        "initial_rows",
        "clean_rows",
        removed.alias("removed_rows"),
        F.try_divide(removed * 100.0, F.col("initial_rows")).alias("removed_pct"),
        "bad_timestamps",
    )


def observed(
    df: DataFrame, observation: Observation, positive: Sequence[str], timestamps: Sequence[str] = (), drop_nan: bool = False
) -> DataFrame:
    """The same rows; the numbers of ``quality_report`` are there once they have been used."""
    return df.observe(observation, *_report_columns(df, positive, timestamps, drop_nan))


def clean(
    df: DataFrame,
    positive: Sequence[str],
    timestamps: Sequence[str],
    flag: str | None = None,
    flag_true: str = "Y",
    drop_nan: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Filter, flag and casts in one projection; other columns pass through untouched.

    An ``observation`` collects the numbers of ``quality_report`` while the result is
    written, so that the report costs no scan of its own.
    """
    if observation is not None:
        df = observed(df, observation, positive, timestamps, drop_nan)
    kept = positive_rows(df, positive, drop_nan)
    if flag is not None:
        kept = flag_to_boolean(kept, flag, flag_true)
    return to_timestamps(kept, timestamps)
