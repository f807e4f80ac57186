"""What several operators on documents share."""
from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: A table of at most so many narrow rows may be sent to every executor.
BROADCAST_ROWS = 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; the rows lie where every executor reads them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place that the cluster names."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir()
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base}/tidemark-{uuid.uuid4().hex}"


def trim() -> None:
    """Give memory that a worker no longer uses back to the system: idle workers stay while the next stage runs."""
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        give_back(0)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Settle a table and mark it for broadcast if its counted rows are few; else leave the join to Spark."""
    df = settled(df)
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where a filter above is pushed below the projection."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Names a row by id and text. Rows that share both share a key, and so every decision."""
    return F.coalesce(F.unhex(F.md5(F.concat_ws("\u0001", F.coalesce(F.col(id_column).cast("string"), F.lit("null")), F.col(text_column).isNull().cast("string"), text_or_empty(text_column)))), F.lit(b""))


def replacing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; one that has the same name, in any case, gives way."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])
