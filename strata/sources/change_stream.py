"""A table's change stream with a stored offset.

The stream keeps the snapshot it consumed last, in buckets by key, and a digest
of each bucket. ``consume`` reads the table once for its digests; only buckets
whose digest differs are copied and compared, and the rest of the old snapshot
is not read. The net changes go to a function, and the offset moves when that
function has returned, so each change is consumed once:

* the new buckets are written before anything reads them, under the next offset;
  the manifest (bucket, version, digest) written after them commits them;
* a call that breaks off leaves the offset where it was, and the next call takes
  the same snapshot with the same batch id, so a merge keyed by it is not repeated;
* changes made after that snapshot are seen by the call after. So are changes made
  between the two reads of a call: digests of the copied buckets are taken from the copy.

Nothing is copied when nothing changed. Versions of a bucket before the offset's are
deleted. A manifest has at most ``buckets`` rows; a bucket of a hot key is written and
compared by several tasks, but is read whole when any of its rows changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.cdc import change_feed
from strata.sources import files

VERSION, BUCKET = "_stream_version", "_stream_bucket"
_NESTED = (T.ArrayType, T.StructType)


def _row_hash(table: DataFrame, seed: int) -> F.Column:
    """Hash of a row's non-null values and their columns' names: a NULL counts as an
    absent column, so adding an empty column changes no digest."""
    parts = []
    for field in sorted(table.drop(BUCKET).schema.fields, key=lambda f: f.name):
        c = F.col(f"`{field.name}`")
        parts += [F.when(c.isNotNull(), F.lit(field.name)),
                  F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(field.dataType, _NESTED) else c]
    return F.xxhash64(F.lit(seed), *parts)


def digests(table: DataFrame, bucket: F.Column) -> DataFrame:
    """Rows and two sums of row hashes per bucket: independent of order, and repeated rows count."""
    def total(seed: int) -> F.Column:
        return F.sum(_row_hash(table, seed).cast("decimal(20,0)")).cast("string")

    return table.groupBy(bucket.cast("int").alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n"), total(1).alias("first"), total(2).alias("second"))


class ChangeStream:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64) -> None:
        """Without keys, rows are dealt by all their values and no change is an update."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        stored = files.names(spark, f"{self.path}/_buckets")  # an existing stream keeps its count
        self.buckets = int(stored[0]) if stored else buckets
        self.changed: list[int] = []  # buckets read and compared by the last call

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    def _manifest(self, offset: int) -> str:
        return f"{self.path}/manifest-{offset}"

    def _bucket(self, table: DataFrame) -> F.Column:
        by = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]) if self.keys else _row_hash(table, 0)
        return F.pmod(by, F.lit(self.buckets)).cast("int")

    def offset(self) -> int | None:
        """The last offset that was consumed (0: none since creation; None: not created)."""
        return max((int(n) for n in files.names(self.spark, f"{self.path}/_offsets")), default=None)

    def _read_manifest(self, offset: int) -> dict[int, dict]:
        return {r[BUCKET]: r.asDict() for r in self.spark.read.parquet(self._manifest(offset)).collect()}  # <= buckets rows

    def _copy(self, table: DataFrame, version: int, only: Sequence[int] | None) -> dict[int, dict]:
        """Write the rows (of some buckets) as a version; returns the manifest rows of what was written."""
        if not files.exists(self.spark, self.rows):
            files.make_folder(self.spark, self.rows)
        clash = {c.lower() for c in table.columns} & {VERSION, BUCKET}
        if clash:
            raise ValueError(f"column names of the stream itself: {sorted(clash)}")
        dealt = table.withColumn(BUCKET, self._bucket(table))
        if only is not None:
            dealt = dealt.filter(F.col(BUCKET).isin(list(only)))
        (dealt.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(BUCKET).parquet(f"{self.rows}/{VERSION}={version}"))
        schema = table.schema.json()
        entry = {BUCKET: None, VERSION: version, "schema": schema}
        copied = self._scan([{**entry, BUCKET: b} for b in (range(self.buckets) if only is None else only)], table.schema)
        return {r[BUCKET]: {**r.asDict(), VERSION: version, "schema": schema}
                for r in digests(copied, F.col(BUCKET)).collect()}  # <= buckets rows

    def _scan(self, entries: Sequence[dict], default: T.StructType) -> DataFrame:
        """The rows of manifest entries, with their bucket; only those partitions are read."""
        layout: dict[str, dict[int, list[int]]] = {}
        for e in entries:
            layout.setdefault(e["schema"], {}).setdefault(e[VERSION], []).append(e[BUCKET])
        out = None
        for schema, versions in sorted(layout.items()):
            fields = T.StructType.fromJson(json.loads(schema)).fields
            full = T.StructType([*fields, T.StructField(VERSION, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
            wanted = F.lit(False)
            for version, held in sorted(versions.items()):
                wanted = wanted | ((F.col(VERSION) == version) & F.col(BUCKET).isin(held))
            part = self.spark.read.schema(full).parquet(self.rows).filter(wanted).drop(VERSION)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        if out is None:
            return self.spark.createDataFrame([], T.StructType([*default.fields, T.StructField(BUCKET, T.IntegerType())]))
        return out

    def _commit(self, offset: int, entries: dict[int, dict]) -> None:
        schema = f"{BUCKET} int, n long, first string, second string, {VERSION} int, schema string"
        names = [BUCKET, "n", "first", "second", VERSION, "schema"]
        (self.spark.createDataFrame([tuple(e[k] for k in names) for e in entries.values()], schema)
         .coalesce(1).write.mode("overwrite").parquet(self._manifest(offset)))

    def create(self, table: DataFrame) -> ChangeStream:
        """Start at the table's state of now; an existing stream stays as it is."""
        if self.offset() is None:
            files.touch(self.spark, f"{self.path}/_buckets/{self.buckets}")
            self._commit(0, self._copy(table, 0, None))
            files.touch(self.spark, f"{self.path}/_offsets/0")
        return self

    def _advance(self, table: DataFrame, last: int) -> None:
        """Copy the buckets that differ from the last offset, and commit the next manifest."""
        old = self._read_manifest(last)
        state = {r[BUCKET]: r.asDict() for r in digests(table, self._bucket(table)).collect()}  # <= buckets rows
        differ = _differing(old, state)
        entries = {b: e for b, e in old.items() if b not in differ}
        if differ:
            entries |= self._copy(table, last + 1, differ)
        self._commit(last + 1, entries)

    def consume(self, table: DataFrame, apply: Callable[[DataFrame, str], object]) -> object:
        """``apply(feed, batch_id)`` on the changes up to the state of now (or
        up to the snapshot of a call that broke off); returns its result."""
        last = self.offset()
        if last is None:
            raise ValueError("create the stream first")
        if not files.written(self.spark, self._manifest(last + 1)):
            self._advance(table, last)
        old, new = self._read_manifest(last), self._read_manifest(last + 1)
        self.changed = _differing(old, new)
        before, after = ([e for b, e in m.items() if b in set(self.changed)] for m in (old, new))
        schema = T.StructType.fromJson(json.loads(after[0]["schema"])) if after else table.schema
        feed = change_feed(self._scan(before, schema).drop(BUCKET), self._scan(after, schema).drop(BUCKET), self.keys)
        result = apply(feed, f"offset-{last + 1}")
        files.touch(self.spark, f"{self.path}/_offsets/{last + 1}")
        self._clean(last, new)
        return result

    def _clean(self, last: int, held: dict[int, dict]) -> None:
        """Delete what no entry of the manifest names, also what a lost call left behind."""
        keep = {(e[VERSION], b) for b, e in held.items()}
        for folder in files.names(self.spark, self.rows):
            if not folder.startswith(f"{VERSION}="):
                continue
            version = int(folder.split("=")[1])
            for sub in files.names(self.spark, f"{self.rows}/{folder}"):
                if sub.startswith(f"{BUCKET}=") and (version, int(sub.split("=")[1])) not in keep:
                    files.delete(self.spark, f"{self.rows}/{folder}/{sub}")
            if version not in {v for v, _ in keep}:
                files.delete(self.spark, f"{self.rows}/{folder}")
        files.delete(self.spark, self._manifest(last))


def _differing(old: dict[int, dict], new: dict[int, dict]) -> list[int]:
    def digest(entries: dict[int, dict], b: int):
        return tuple(entries[b][k] for k in ("n", "first", "second")) if b in entries else None

    return sorted(b for b in old.keys() | new.keys() if digest(old, b) != digest(new, b))
