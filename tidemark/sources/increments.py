"""Files that are new since the last time, taken into a table exactly once."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import TableStore

#: Names the partition that one batch of new files fills.
BATCH = "batch"
#: Files count as new whatever their age; by default late ones would be passed over.
ANY_AGE = "36500d"


def append_new_files(
    store: TableStore,
    path: str,
    name: str,
    change: Callable[[DataFrame], DataFrame],
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Append ``change`` of the rows in Parquet files that no earlier call has read; returns the number of batches.

    ``path`` is a folder, or a pattern of folders or files (a single file, too, has to be named by a pattern).
    ``watch`` gets the rows of every batch first, to observe them; ``change`` also gets an empty frame, for the layout.

    A file stream that ends when nothing new is left. Its checkpoint, beside the table, holds which files were
    read, and gives every batch a number. A batch fills the partition of its number: if its writer died, it
    is repeated under the same number and replaces what it left, so every file counts once. The table is created
    empty before the first file is read; a checkpoint without its table is a leftover and goes. A file is
    known by its path: one that is written anew in place is not read again. The driver keeps the paths.
    """
    if store.format == "delta":
        raise ValueError("new files go into partitions that a repeated batch replaces; Delta tables are not written so")
    spark, progress = store.spark, store.folder_beside(name, "stream")
    schema = spark.read.parquet(path).schema
    if not store.exists(name):
        store.remove_folder(progress)
        empty = spark.createDataFrame([], change(spark.createDataFrame([], schema)).schema)
        store.overwrite(empty.withColumn(BATCH, F.lit(0).cast("long")), name, partition_by=[BATCH])
    done = []

    def take(rows: DataFrame, number: int) -> None:
        # a batch runs in a session of its own
        there = replace(store, spark=rows.sparkSession)
        there.append(change(watch(rows)).withColumn(BATCH, F.lit(number).cast("long")), name, [BATCH], replace_partitions=True)
        done.append(number)

    rows = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(path)
    stream = rows.writeStream.foreachBatch(take).option("checkpointLocation", progress).trigger(availableNow=True).start()
    stream.awaitTermination()
    spark.catalog.refreshTable(name)
    return len(done)
