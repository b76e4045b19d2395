"""Uniform shuffle into shards of exact size, by a hypergeometric
communication matrix.

How many rows each input partition sends to each shard is drawn first, as a
multivariate hypergeometric matrix whose rows sum to the partition sizes and
whose columns sum to the shard sizes. Partitions are then permuted locally
and cut at those counts, rows are exchanged, and every shard is permuted
again. Every permutation of the rows is equally likely, and shard sizes
differ by at most one row (law ``rows``).

Defined results
* Nulls in any column are ordinary values; a null text has size 1 and no checksum.
* Rows that repeat each other are separate rows, each with a slot of its own.
* With fewer rows than shards, the last shards are empty; an empty table gives no rows.
* The same seed and the same input layout give the same result.
* Other columns are carried along; ``shard`` and ``slot`` of the input are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import blocks_for, fresh, materialize, number_in_groups

ROWS_PER_BLOCK = 4096
NUMPY_LIMIT = 10**9  # fixed value: Generator.hypergeometric takes fewer than this of each kind


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good, for any sizes.

    Beyond numpy's limit: two binomial counts of one probability, given that
    they sum to ``n``, are hypergeometric, so pairs are drawn until one does."""
    if good < NUMPY_LIMIT and bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    if good * bad < n * (total - n):  # drawn and good may change roles; the smaller spread hits sooner
        good, bad, n = n, total - n, good
    p = n / total
    tries = min(1 << 16, int(4 * (n * (1 - p)) ** 0.5) + 16)
    while True:
        x = rng.binomial(good, p, tries)
        hits = np.flatnonzero(x + rng.binomial(bad, p, tries) == n)
        if len(hits):
            return int(x[hits[0]])


def communication_matrix(sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Rows each partition sends to each shard, drawn without replacement."""
    rng, left = np.random.default_rng(seed), np.array(shard_sizes, dtype=np.int64)
    out = np.zeros((len(sizes), len(shard_sizes)), dtype=np.int64)
    for i, n in enumerate(sizes):
        todo, pool = int(n), int(left.sum())
        for k, m in enumerate(left):  # a chain of hypergeometric draws
            pool -= int(m)
            out[i, k] = hypergeometric(rng, int(m), pool, todo) if todo and m and pool >= 0 else 0
            todo -= int(out[i, k])
        left -= out[i]
    return out


def shard(df: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0).

    The driver holds one row of counts per input partition, never rows of data.
    """
    spark, src = df.sparkSession, df.drop("shard", "slot")
    carried = F.struct(*(F.col(f"`{c}`") for c in src.columns)).alias("row")  # in one column, so that no name clashes
    # written, so that partition and row numbers stay what they are if a task runs again
    rows = materialize(src.select(carried, F.spark_partition_id().alias("_part"),
                                 F.monotonically_increasing_id().alias("_uid")), "shard-input")
    rows = rows.withColumn("_first", F.xxhash64(F.lit(seed), F.lit(1), "_uid")).withColumn("_second", F.xxhash64(F.lit(seed), F.lit(2), "_uid"))
    counts = [(r[0], r[1]) for r in rows.groupBy("_part").count().orderBy("_part").collect()]
    total = sum(n for _, n in counts)
    shard_sizes = [total // n_shards + (k < total % n_shards) for k in range(n_shards)]
    matrix = communication_matrix([n for _, n in counts], shard_sizes, seed).cumsum(axis=1)
    cuts = spark.createDataFrame([(p, [int(x) for x in line]) for (p, _), line in zip(counts, matrix)], "_p int, _cuts array<bigint>")
    local = Window.partitionBy("_part").orderBy("_first", "_uid")
    # permute locally, then cut: a row's shard is the number of cuts at or before its place
    sent = (rows.withColumn("_at", F.row_number().over(local) - 1)
            .join(cuts, F.col("_part") == F.col("_p"))
            .withColumn("shard", F.size(F.filter("_cuts", lambda x: x <= F.col("_at"))))
            .select("row", "_uid", "_second", "shard"))
    blocks = F.lit(blocks_for(max(shard_sizes), ROWS_PER_BLOCK))
    return number_in_groups(sent, "shard", "_second", blocks, ["_uid"], "slot").select("row.*", "shard", "slot")


def write_shards(df: DataFrame, n_shards: int, path: str, seed: int = 0, rows_per_file: int = 100_000) -> None:
    """Write ``df`` as one folder per shard, in slot order within each file;
    ``rows_per_file`` cuts shards, so no task writes a whole one."""
    part = fresh(df, "part")
    (shard(df, n_shards, seed).withColumn(part, F.floor(F.col("slot") / rows_per_file))
     .repartition("shard", part).sortWithinPartitions("shard", part, "slot")
     .write.partitionBy("shard", part).parquet(path))
