"""Run queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""
from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v

    return sorted((tuple(plain(v) for v in row) for row in frame.itertuples(index=False)), key=repr)


def difference(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """None if query and SQL agree, else what differs first."""
    found = QUERIES[name](spark, sf_dir).toPandas()
    wanted = connect(sf_dir).execute(ORACLES[name]).df()
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} / {sorted(wanted.columns)}"
    a, b = rows(found), rows(wanted)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows, first {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                result = difference(spark, sf_dir, name)
                text = "equal" if result is None else f"DIFFERENT {result}"
            else:
                text = f"{len(QUERIES[name](spark, sf_dir).toPandas())} rows, no SQL"
        except Exception as e:
            text = f"FAILED {type(e).__name__} {str(e)[:600]}"
        bad += text.startswith(("DIFF", "FAIL"))
        print(f"{name:48} {time.time() - start:6.2f} s  {text}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
