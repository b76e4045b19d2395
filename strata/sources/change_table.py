"""Bucketed parquet tables that only append: each batch adds its rows as one change, and reading merges the changes.

A table whose batches hit every bucket cannot be rewritten per batch: the
bytes would grow with table size times batches. Here a batch writes its own
rows once. The files are Spark's own bucketed format (``CLUSTERED BY``), so a
join or window by the keys reads them without a shuffle, also over many changes.

A change counts once its marker is there (``_batches/<batch>--<number>``). An
attempt has a number of its own, so rows of one that broke off are never read,
and a batch that was applied is skipped. After ``MOST_CHANGES`` the merged rows are
written into a folder of their own (``rows-<number>``) that later changes join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import files

CHANGE = "_change"  # the number of the change a row came with; later ones are greater
MOST_CHANGES = 50  # so many are merged when read before they are written as one


class ChangeTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int, schema: T.StructType,
                 merged: Callable[[DataFrame], DataFrame]):
        """``schema``: the columns of a change; ``merged``: from the rows of all
        changes (``schema`` and ``_change``) to those of the table."""
        self.spark, self.path, self.keys, self.schema, self.merged = spark, path.rstrip("/"), list(keys), schema, merged
        # an existing table keeps the count it was written with
        stored = files.names(spark, f"{self.path}/_buckets")
        self.buckets = int(stored[0]) if stored else buckets
        files.touch(spark, f"{self.path}/_buckets/{self.buckets}")
        self._table(self._base())

    def _base(self) -> int:
        """The last change that was written together with all before it (0: none)."""
        return max(map(int, files.names(self.spark, f"{self.path}/_bases")), default=0)

    def _folder(self, base: int) -> str:
        return f"{self.path}/rows-{base}"

    def _table(self, base: int) -> str:
        """The catalog's name of the table in this folder."""
        files.make_folder(self.spark, self._folder(base))
        name = f"changes_{hashlib.md5(self._folder(base).encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (*self.schema.fields, T.StructField(CHANGE, T.LongType())))
        by = ", ".join(f"`{k}`" for k in self.keys)
        location = self._folder(base).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{location}'")
        return name

    # -- read ----------------------------------------------------------------
    def _applied(self) -> dict[str, int]:
        marks = (name.rpartition("--") for name in files.names(self.spark, f"{self.path}/_batches"))
        return {batch: int(number) for batch, _, number in marks}

    def changes(self) -> DataFrame:
        """The rows of all changes, with their numbers."""
        base = self._base()
        name = self._table(base)
        self.spark.catalog.refreshTable(name)  # other sessions add files
        return self.spark.table(name).filter(F.col(CHANGE).isin(self._numbers(base)))

    def _numbers(self, base: int) -> list[int]:
        return sorted(n for n in self._applied().values() if n >= base)

    def change(self, batch_id: str) -> DataFrame:
        """The rows that ``batch_id`` added."""
        return self.changes().filter(F.col(CHANGE) == self.number(batch_id))

    def number(self, batch_id: str) -> int:
        return self._applied()[batch_id]

    def read(self) -> DataFrame:
        return self.merged(self.changes())

    # -- write ---------------------------------------------------------------
    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` in the table's buckets: further joins and windows by the keys move nothing."""
        return rows.repartition(self.buckets, *self.keys)

    def applied(self, batch_id: str) -> bool:
        return batch_id in self._applied()

    def _mark(self, batch_id: str) -> None:
        files.touch(self.spark, f"{self.path}/_batches/{batch_id}")

    def append(self, rows: DataFrame, batch_id: str) -> None:
        """Add ``rows``, which are dealt in buckets already, as one change."""
        if self.applied(batch_id):
            return
        number = 1 + max(map(int, files.names(self.spark, f"{self.path}/_attempts")), default=0)
        files.touch(self.spark, f"{self.path}/_attempts/{number}")
        self._write(rows, number, self._base())
        self._mark(f"{batch_id}--{number}")

    def _write(self, rows: DataFrame, number: int, base: int) -> None:
        rows.select(*self.schema.fieldNames(), F.lit(number).cast("long").alias(CHANGE)).write.mode("append").insertInto(self._table(base))

    def compact(self) -> None:
        """Write the merged rows once there are many changes; buckets stay where they are. To be
        called between batches. The folder before is kept for those who still read it."""
        base = self._base()
        numbers = self._numbers(base)
        if len(numbers) <= MOST_CHANGES:
            return
        files.delete(self.spark, self._folder(numbers[-1]))  # what an attempt left that broke off
        self._write(self.read(), numbers[-1], numbers[-1])
        files.touch(self.spark, f"{self.path}/_bases/{numbers[-1]}")
        for name in files.names(self.spark, self.path):
            if name.startswith("rows-") and int(name[5:]) < base:
                files.delete(self.spark, f"{self.path}/{name}")
