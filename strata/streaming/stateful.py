"""Keep the latest row per key with Spark's own state store.

``DynamicTables`` finds the stored row of a key by joining a batch to the
table. Here the state store holds it: a streaming ``max_by`` in update mode
gives the rows that a batch changed, and only those are written. The state
survives a restart in the query's checkpoint. Choose this form where the state
(a row per key) fits the executors' disks and batches are small; the state
store should then be the one on RocksDB, as it keeps the state out of the heap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources.store import BucketedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row per key by ``order`` (NULL ranks above all values, as in
    ``DESC NULLS FIRST``), as a streaming aggregate."""
    values = [c for c in stream.columns if c not in keys]
    rank = F.struct(*(x for c in order for x in (F.col(c).isNull(), F.col(c))))
    return stream.groupBy(*keys).agg(F.max_by(F.struct(*values), rank).alias("row")).select(*keys, "row.*").select(*stream.columns)


def drain_latest(stream: DataFrame, table: BucketedTable, order: Sequence[str], checkpoint: str) -> None:
    """Bring ``table`` (one row per its key) up to date with what has arrived on ``stream``."""
    spark = stream.sparkSession
    if not table.exists():
        table.write(spark.createDataFrame([], stream.schema))

    def upsert(rows: DataFrame, batch_id: int) -> None:
        pinned = rows.checkpoint()  # the batch's plan updates the state: run it once
        table.merge(pinned, lambda stored, new: stored.join(new.select(*table.keys), table.keys, "left_anti").unionByName(new),
                    batch_id=batch_id, may_delete=False)

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    (latest_rows(stream, table.keys, order).writeStream.outputMode("update").foreachBatch(upsert)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
