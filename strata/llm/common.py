"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows survives lost executors without running
    the stages before it again, and sees the same rows each time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_id(id_col: Column, text: Column) -> Column:
    """Identity of a document row: its id and a hash of its text.

    Never null, so rows without an id can be joined too. Two rows have the
    same identity only if they repeat a document.
    """
    return F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("-")), F.hex(F.xxhash64(text)))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose identity is in ``kept`` (column ``rid``), each once."""
    rid = fresh(docs, "rid")
    return (docs.withColumn(rid, row_id(F.col(id_col), F.col(text_col)))
            .join(kept.select(F.col("rid").alias(rid)), rid, "left_semi")
            .dropDuplicates([rid]).select(*docs.columns))


def number_in_groups(df: DataFrame, group: str, order: str, n_blocks: Column, ties: Sequence[str], out: str) -> DataFrame:
    """Number the rows of each group from 0 in the order of the 64-bit hash
    ``order``, without ever bringing a group into one task.

    The hash range of a group is cut into ``n_blocks`` equal blocks. Rows are
    numbered inside each block; a block starts where the blocks before it end.
    Rows that agree on ``order`` and ``ties`` are interchangeable.
    """
    block = (F.shiftrightunsigned(F.col(order), 32) * n_blocks.cast("long") / F.lit(2.0**32)).cast("long")
    rows = df.withColumn("_block", F.least(block, n_blocks.cast("long") - 1))
    sizes = rows.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("_g"), F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_block").orderBy(F.col(order), *(F.col(c) for c in ties))
    return (rows.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(starts, (F.col(group) == F.col("_g")) & (F.col("_block") == F.col("_b")))
            .withColumn(out, F.col("_start") + F.col("_rank"))
            .drop("_block", "_rank", "_g", "_b", "_start"))


def blocks_for(rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(rows / rows_per_block))


def with_fields(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``df`` and more columns."""
    schema = T.StructType(list(df.schema.fields))
    for name, kind in fields:
        schema = schema.add(name, kind)
    return schema


def slices(batch, column: str, max_bytes: int = 8 << 20):
    """Cut an Arrow batch so that the texts of a piece take at most
    ``max_bytes`` (one longer text is a piece of its own)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) if isinstance(sizes, pa.Array) else np.zeros(0)
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
