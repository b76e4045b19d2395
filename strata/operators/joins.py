"""Join helpers: size-checked broadcast and the OR-NULL semi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above this many rows a side is never broadcast by us; AQE still may, but
# only after measuring it against spark.sql.autoBroadcastJoinThreshold.
BROADCAST_MAX_ROWS = 100_000


def row_count_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most ``n`` rows, reading as little as possible.

    ``select(lit).limit(n + 1).collect()`` is a collect-limit: Spark scans
    partitions incrementally and stops once n + 1 rows are found, and at most
    n + 1 one-int rows reach the driver. (``limit().count()`` would instead
    gather up to n rows of every partition into one task.)
    """
    return len(df.select(F.lit(1).alias("_one")).limit(n + 1).collect()) <= n


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows;
    beyond the bound it is returned unchanged and the planner picks a
    shuffle join."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def semi_join_or_null(left: DataFrame, mapping: DataFrame, left_col: str, map_col: str) -> DataFrame:
    """Rows of ``left`` with a mapping row whose value equals ``left_col`` or is NULL.

    ``EXISTS (SELECT 1 FROM m WHERE m.v = l.c OR m.v IS NULL)`` as one outer
    equi-join to the distinct values plus a wildcard test, so it never becomes
    a nested-loop join and reads ``left`` once. A NULL ``left_col`` only
    passes via the wildcard (NULL = x is unknown).
    """
    has_wildcard = mapping.filter(F.col(map_col).isNull()).exists()
    values = mapping.filter(F.col(map_col).isNotNull()).select(F.col(map_col).alias("_mapped")).distinct()
    return (left.join(values, left[left_col] == F.col("_mapped"), "left")
            .filter(F.col("_mapped").isNotNull() | has_wildcard).drop("_mapped"))
