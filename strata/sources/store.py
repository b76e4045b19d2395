"""Parquet tables with a hash-bucket column, rewritten one touched bucket at a time.

There is no transactional table format on the classpath, so a MERGE on a
file table is: find the partitions the source touches (hash bucket, plus an
optional period level; at most periods x buckets values, a proven bound),
read only those (partition pruning), merge them with
``strata.operators.merge`` and overwrite those partitions dynamically (Spark
commits them only after every task has read the old files). Merges that may
delete rows pin their result first, so partitions they empty are removed.
Every applied batch id is recorded so a replayed micro-batch is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import files

BUCKET = "_b"
PERIOD = "_p"


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 16,
                 schema: T.StructType | None = None, default_schema: T.StructType | None = None,
                 period: tuple[str, str] | None = None):
        """``schema`` fixes the read schema; otherwise it is taken from the files,
        or from ``default_schema`` while the table has no data files yet.

        ``period=(date_column, grain)`` adds a leading partition level
        ``trunc(date_column, grain)``: a batch of recent rows then rewrites only
        the buckets of its periods, not of the whole table. The date column must
        never change for a key (an order keeps its order date).
        """
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = schema
        self.default_schema = default_schema
        self.period = period
        self.parts = [PERIOD, BUCKET] if period else [BUCKET]
        # an existing table keeps the count it was written with
        stored = files.names(spark, f"{self.path}/_buckets")
        self.buckets = int(stored[0]) if stored else buckets

    # -- layout --------------------------------------------------------
    def bucket_of(self) -> F.Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _with_parts(self, df: DataFrame) -> DataFrame:
        out = df.withColumn(BUCKET, self.bucket_of())
        if self.period:
            out = out.withColumn(PERIOD, F.trunc(F.col(self.period[0]), self.period[1]))
        return out

    def touched_partitions(self, df: DataFrame) -> list[tuple]:
        """Distinct partition values of ``df`` (at most periods x buckets)."""
        return [tuple(r) for r in self._with_parts(df).select(*self.parts).distinct().collect()]

    def _prune(self, touched: list[tuple]) -> F.Column:
        cond = F.col(BUCKET).isin(sorted({t[-1] for t in touched}))
        if self.period:
            periods = {t[0] for t in touched}
            pc = F.col(PERIOD).isin(sorted((p for p in periods if p is not None), key=str))
            if None in periods:  # a NULL date lives in the default partition; isin never matches NULL
                pc = pc | F.col(PERIOD).isNull()
            cond = cond & pc
        return cond

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def exists(self) -> bool:
        fs, jvm = self._fs()
        return fs.exists(jvm.org.apache.hadoop.fs.Path(self.path + "/_SUCCESS"))

    # -- read / write ----------------------------------------------------
    def _scan(self) -> DataFrame:
        schema = self._read_schema()
        if schema is None:
            return self.spark.read.parquet(self.path)
        return self.spark.read.schema(schema).parquet(self.path)

    def _read_schema(self) -> T.StructType | None:
        """Explicit read schema (data columns + partition columns), or None to infer."""
        schema = self.schema
        if schema is None:
            try:
                self.spark.read.parquet(self.path).schema
                return None
            except AnalysisException:
                if self.default_schema is None or not self.exists():
                    raise
                schema = self.default_schema
        extra = [T.StructField(PERIOD, T.DateType())] if self.period else []
        return T.StructType(schema.fields + extra + [T.StructField(BUCKET, T.IntegerType())])

    def read(self) -> DataFrame:
        return self._scan().drop(*self.parts)

    def read_touched(self, keys_df: DataFrame, touched: list[tuple] | None = None) -> DataFrame:
        """Only the partitions holding the keys of ``keys_df`` (partition pruning)."""
        if touched is None:
            touched = self.touched_partitions(keys_df)
        if not touched:
            return self.read().limit(0)
        return self._scan().filter(self._prune(touched)).drop(*self.parts)

    def write(self, df: DataFrame) -> None:
        """Full overwrite, clustered by bucket.

        ``rebalance`` (not ``repartition``) lets AQE split a bucket that holds
        a hot key over several writer tasks instead of one.
        """
        (self._with_parts(df).hint("rebalance", *self.parts)
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*self.parts).parquet(self.path))
        files.touch(self.spark, f"{self.path}/_buckets/{self.buckets}")

    def applied(self, batch_id) -> bool:
        fs, jvm = self._fs()
        return batch_id is not None and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_batches/{batch_id}"))

    def _mark(self, batch_id) -> None:
        if batch_id is None:
            return
        fs, jvm = self._fs()
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_batches/{batch_id}"), True).close()

    def merge(self, source: DataFrame, fn: Callable[[DataFrame, DataFrame], DataFrame], batch_id=None,
              may_delete: bool = True, touched: list[tuple] | None = None) -> int | None:
        """Rewrite the partitions touched by ``source`` with ``fn(target_part, source)``.

        ``may_delete=False`` promises that ``fn`` never removes a key (upserts),
        so no touched partition can end up empty and that check is skipped.
        ``touched`` may pass partitions already computed for the same keys.
        Returns the number of touched partitions (0: empty source), or None
        when ``batch_id`` was applied before (idempotent replay).
        """
        if self.applied(batch_id):
            return None
        if touched is None:
            touched = self.touched_partitions(source)  # <= periods x buckets values
        if not touched:
            self._mark(batch_id)
            return 0
        part = self._scan().filter(self._prune(touched)).drop(*self.parts)
        merged = self._with_parts(fn(part, source)).hint("rebalance", *self.parts)
        if may_delete:
            # which touched partitions end up empty must be known before the write;
            # pin the merge result so it is computed once
            merged = merged.checkpoint(eager=True)
            present = {tuple(r) for r in merged.select(*self.parts).distinct().collect()}
        else:
            # upserts: every touched partition keeps rows. Dynamic overwrite commits only
            # after all tasks finished reading the old files, so retries still see
            # them, and a batch replayed after a partial commit is a no-op upsert.
            present = set(touched)
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.parts).parquet(self.path))
        # partitions emptied by deletes are not in the output: remove them
        fs, jvm = self._fs()
        for t in set(touched) - present:
            sub = "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(self.parts, t))
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}"), True)
        self._mark(batch_id)
        return len(touched)
