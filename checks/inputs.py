"""The given tables in the roles the operators expect, and how results are presented."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cleaning, daily

POSITIVE = ("l_discount", "l_tax")
LINE_AVERAGES = {"avg_price": "l_extendedprice", "avg_quantity": "l_quantity"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_rows_of(table(spark, sf_dir, "lineitem"))


def clean_rows_of(lines: DataFrame) -> DataFrame:
    return cleaning.clean(lines, POSITIVE, ("l_shipdate",), "l_returnflag", "R")


def daily_lines(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """One series, or one per key, of average price with average quantity and row count."""
    return daily.daily_features(
        clean_lines(spark, sf_dir),
        "l_shipdate",
        LINE_AVERAGES,
        "n_rows",
        keys,
    )


def daily_events(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return daily.daily_features(
        table(spark, sf_dir, "events"), "ts", {"avg_value": "value"}, "n_events", keys
    )


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and write dates as text, so that two engines can be compared.

    The small shift keeps values that lie exactly between two roundings (an average over 32
    rows, say) from depending on their last bit; the SQL side adds the same.
    """
    shift = 3.0 * 10 ** -(digits + 2)
    columns = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        column = F.col(f"`{f.name}`")
        if kind == "double":
            column = F.round(column + shift, digits)
        elif kind == "date" or kind.startswith("timestamp"):
            column = column.cast("string")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def sql_round(expression: str, digits: int = 6) -> str:
    return f"round(({expression}) + 3e-{digits + 2}, {digits})"
