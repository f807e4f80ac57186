"""Catalog tables: scan, overwrite and append with the schema rules of the job."""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SchemaMismatch(ValueError):
    """A write would change the schema of a table whose schema is fixed."""


def _layout(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields]


#: Name of the record of a change that needs more than one catalog statement.
INTENT = "_intent"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@dataclass(frozen=True)
class Buckets:
    """Rows with equal values in ``columns`` lie in one of ``number`` files, in every table bucketed alike."""

    columns: tuple[str, ...]
    number: int

    def deal(self, df: DataFrame) -> DataFrame:
        """One task, and so one file, for each bucket; Spark hashes rows into both alike."""
        return df.repartition(self.number, *self.columns)

    def clause(self) -> str:
        columns = ", ".join(f"`{c}`" for c in self.columns)
        return f"CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {self.number} BUCKETS "


@dataclass(frozen=True)
class TableStore:
    """Tables of one catalog in one format.

    ``delta`` leaves schema rules to Delta's own write options.  In any other format a table that is
    overwritten consists of snapshots: every overwrite writes a folder of its own beside the earlier ones
    (``<table>.snapshots`` in the database's folder), complete before anything else happens, and then the
    catalog names it.  No folder is renamed or written twice.  With the same columns that is one catalog
    statement.  With other columns, or partitions, the table has to be dropped and created; a record of the
    intent is created first, if no other is there, and whoever looks at the table next finishes the change.  A
    writer that dies leaves the old rows or the new ones under the name.  One earlier snapshot stays for
    readers that have begun.  One writer at a time: a second one fails at the record, or its rows come last.

    With ``buckets``, joins and aggregates on those columns need no exchange.  Only named tables can be written
    so, hence a snapshot is first named by itself; a writer that dies there may leave that name behind.
    """

    spark: SparkSession
    format: str = "parquet"

    def exists(self, name: str) -> bool:
        self.recover(name)
        return self.spark.catalog.tableExists(name)

    def read(self, name: str) -> DataFrame:
        self.recover(name)
        return self.spark.read.table(name)

    def overwrite(
        self,
        df: DataFrame,
        name: str,
        replace_schema: bool = False,
        partition_by: Sequence[str] = (),
        buckets: Buckets | None = None,
    ) -> None:
        there = self.exists(name)
        if there and not replace_schema:
            held, new = _layout(self.read(name)), _layout(df)
            if held != new:
                raise SchemaMismatch(f"{name} holds {held}, the new rows have {new}")
        self._allow(buckets)
        writer = (buckets.deal(df) if buckets else df).write.format(self.format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.format == "delta":
            options = {"overwriteSchema": "true"} if replace_schema else {}
            writer.mode("overwrite").options(**options).saveAsTable(name)
            return
        folder = f"{self._root(name)}/{uuid.uuid4().hex}"
        if buckets:
            alone = f"{name}_{uuid.uuid4().hex}"
            writer.bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns).option("path", folder).saveAsTable(alone)
            self.spark.sql(f"DROP TABLE {alone}")  # the name only, files outside the warehouse's own folder stay
        else:
            writer.save(folder)
        before = self._snapshot(name) if there else None
        plain = before is not None and not partition_by and not self._partitions(name)
        if plain and self._buckets(name) == buckets and _layout(self.read(name)) == _layout(df):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
        else:
            self._intend(name, folder, df, partition_by, buckets)
            self.recover(name)
        self._forget(name, keep=(folder, before))

    def append(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        replace_partitions: bool = False,
        buckets: Buckets | None = None,
    ) -> None:
        """Add rows; columns the table lacks are added, columns the rows lack become null.

        With ``replace_partitions``, rows of a partition that the new rows bring again give way: a step whose
        rows carry a key of their own as partition can be repeated without doubling them.  A table that
        is not partitioned that way gets the rows added.  ``buckets`` are those of the first append.
        """
        self._allow(buckets)
        there = self.exists(name)
        if self.format != "delta" and there:
            df = self._widen(df, name)
        if buckets:
            df = buckets.deal(df)
        if there and replace_partitions and self.format != "delta" and set(partition_by) == set(self._partitions(name)) and partition_by:
            self._replace_partitions(df, name)
            return
        writer = df.write.format(self.format).mode("append").option("mergeSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns)
        writer.saveAsTable(name)

    def _allow(self, buckets: Buckets | None) -> None:
        if buckets and self.format == "delta":
            raise ValueError("Delta tables have no buckets")

    def _replace_partitions(self, df: DataFrame, name: str) -> None:
        conf, key = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"  # inserts into tables read no option
        before = conf.get(key)
        conf.set(key, "dynamic")
        try:
            df.write.insertInto(name, overwrite=True)
        finally:
            conf.set(key, before)

    def drop_partition(self, name: str, column: str, value: str) -> None:
        """Take back what a step has appended under its key."""
        if self.format != "delta" and column in self._partitions(name):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = '{_quoted(value)}')")
        else:
            kept = self.read(name).where(~F.col(column).eqNullSafe(value))
            self.overwrite(kept, name)

    def drop(self, name: str) -> None:
        """Remove a table with its snapshots, and what it remembers of files it has taken in."""
        self.recover(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.remove_folder(self._root(name))
        self.remove_folder(self.folder_beside(name, "stream"))

    def recover(self, name: str) -> None:
        """Finish a change of columns or partitions that a writer has begun."""
        record = self._path(f"{self._root(name)}/{INTENT}")
        files = self._files(record)
        if self.format == "delta" or not files.exists(record):
            return
        stream = files.open(record)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            wanted = json.loads(text)
        except ValueError:  # its writer died before the record was whole, so the old table is untouched
            files.delete(record, False)
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        parts = ", ".join(f"`{c}`" for c in wanted["partition_by"])
        self.spark.sql(
            f"CREATE TABLE {name} ({wanted['columns']}) USING {self.format} "
            + (f"PARTITIONED BY ({parts}) " if parts else "")
            + (Buckets(*wanted["buckets"]).clause() if wanted.get("buckets") else "")
            + f"LOCATION '{_quoted(wanted['folder'])}'"
        )
        if parts:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        files.delete(record, False)

    def _intend(self, name: str, folder: str, df: DataFrame, partition_by: Sequence[str], buckets: Buckets | None) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        record = self._path(f"{self._root(name)}/{INTENT}")
        stream = self._files(record).create(record, False)  # fails if another writer's record is there
        wanted = {"folder": folder, "columns": columns, "partition_by": list(partition_by)}
        if buckets:
            wanted["buckets"] = [list(buckets.columns), buckets.number]
        stream.write(bytearray(json.dumps(wanted).encode()))
        stream.close()

    def _forget(self, name: str, keep: Sequence[str | None]) -> None:
        root = self._path(self._root(name))
        files = self._files(root)
        names = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep if k}
        for status in files.listStatus(root):
            if status.isDirectory() and status.getPath().getName() not in names:
                files.delete(status.getPath(), True)

    def remove_folder(self, folder: str) -> None:
        path = self._path(folder)
        self._files(path).delete(path, True)

    def _root(self, name: str) -> str:
        return self.folder_beside(name, "snapshots")

    def folder_beside(self, name: str, what: str) -> str:
        """A folder in the database's own that belongs to a table."""
        *database, table = name.replace("`", "").split(".")
        home = self.spark.catalog.getDatabase(database[-1] if database else self.spark.catalog.currentDatabase())
        return f"{home.locationUri.rstrip('/')}/{table.lower()}.{what}"

    def _snapshot(self, name: str) -> str | None:
        """The folder of the current snapshot; None for a table of another kind."""
        if self.spark.catalog.getTable(name).tableType != "EXTERNAL":
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
        found = rows[0]["data_type"] if rows else ""
        return found if f"/{self._root(name).rsplit('/', 1)[-1]}/" in found else None

    def _buckets(self, name: str) -> Buckets | None:
        columns = tuple(c.name for c in self.spark.catalog.listColumns(name) if c.isBucket)
        if not columns:
            return None
        number = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
        return Buckets(columns, int(number["data_type"]))

    def _partitions(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _widen(self, df: DataFrame, name: str) -> DataFrame:
        held = dict(_layout(self.read(name)))
        for column, kind in _layout(df):
            if held.get(column, kind) != kind:
                raise SchemaMismatch(f"{name}.{column} is {held[column]}, the new rows have {kind}")
        added = [f for f in df.schema.fields if f.name.lower() not in held]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        target = self.read(name).schema.fields
        given = {c.lower() for c in df.columns}
        return df.select(
            *(
                F.col(f"`{f.name}`") if f.name.lower() in given
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in target
            )
        )

    def _qualified(self, path: str) -> str:
        found = self._path(path)
        return self._files(found).makeQualified(found).toString()

    def link(self, path: str, name: str) -> None:
        """Register Parquet files as a table where they lie, without copying them.

        A table of that name goes only if it is a link itself: dropping a managed table would
        delete its rows.  A relative path counts from where ``spark.read`` counts.
        """
        if self.exists(name) and (self.spark.catalog.getTable(name).tableType != "EXTERNAL" or self._snapshot(name)):
            raise ValueError(f"{name} holds rows of its own; drop it yourself before linking {path}")
        location = _quoted(self._qualified(path))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")


def read_delta(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def write_delta(
    df: DataFrame, name: str, mode: str = "overwrite", format: str = "delta", **options: bool
) -> None:
    """Overwrite (``replace_schema=True`` to change the schema) or append to a table."""
    store = TableStore(df.sparkSession, format)
    if mode == "overwrite":
        store.overwrite(df, name, **options)
    elif mode == "append":
        store.append(df, name, **options)
    else:
        raise ValueError("mode must be 'overwrite' or 'append'")
