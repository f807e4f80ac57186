"""File sources."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_from_files(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header row; every column is a string.

    Naming the columns spares the job that reads the header of the first file.
    """
    reader = spark.read.option("header", "true")
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return reader.csv(path)
