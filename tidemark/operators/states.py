"""Daily features as states that merge: sums and counts of a day, from which averages follow.

States of different parts of the input add up to the states of the whole, so a day that is there need not be
read again when rows come in: only new rows are aggregated, and one row per series and day meets another.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

SUM, COUNT = "_sum", "_n"


def _addable(df: DataFrame, source: str) -> Column:
    return F.col(source) if isinstance(df.schema[source].dataType, DecimalType) else F.col(source).cast("double")


def daily_states(
    df: DataFrame,
    ts_col: str,
    averages: dict[str, str],
    count_col: str = "row_count",
    series_keys: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """One row per series and day: sum and count behind every average, and the number of rows.

    Takes what ``daily.daily_features`` takes. Nulls count in no average; rows without a time form a null-date row.
    """
    sums = [
        column
        for name, source in averages.items()
        for column in (F.sum(_addable(df, source)).alias(name + SUM), F.count(source).alias(name + COUNT))
    ]
    return df.groupBy(*series_keys, F.to_date(ts_col).alias(date_col)).agg(*sums, F.count(F.lit(1)).alias(count_col))


def merge_states(
    states: DataFrame, averages: Iterable[str], count_col: str = "row_count", series_keys: Sequence[str] = (), date_col: str = "date"
) -> DataFrame:
    """Add up the states of each series and day; decimals keep their type."""
    kinds = {f.name: f.dataType for f in states.schema.fields}
    added = [c for name in averages for c in (name + SUM, name + COUNT)] + [count_col]
    return states.groupBy(*series_keys, date_col).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in added))


def _average_kind(total: DataType) -> DataType:
    """The type that an average has over values whose sum has this type."""
    if not isinstance(total, DecimalType):
        return total
    precision = total.precision - 6 if total.precision < 38 else 38
    return DecimalType(min(precision, 38), min(total.scale + 4, 38))


def features_of_states(
    states: DataFrame, averages: Iterable[str], count_col: str = "row_count", series_keys: Sequence[str] = (), date_col: str = "date"
) -> DataFrame:
    """The rows that ``daily.daily_features`` gives over all rows behind the states, which may come in parts.

    Sums of doubles depend on their order in the last digits, as averages do.
    """
    averages = list(averages)
    whole = merge_states(states, averages, count_col, series_keys, date_col)
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    means = [F.try_divide(name + SUM, name + COUNT).cast(_average_kind(kinds[name + SUM])).alias(name) for name in averages]
    return whole.select(*series_keys, date_col, *means, count_col)
