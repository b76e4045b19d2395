"""Text helpers shared by the text-analytics operators.

Tokenisation is one rule used everywhere (and mirrored in the oracle SQL):
lower-case, split on every run of non-letters, drop empty tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_SPLIT = r"[^\p{L}]+"
SENTENCE_SPLIT = r"[.!?\n]+"


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Give CPU-heavy per-row text work at least the cluster's parallelism.

    Only repartitions when the input has fewer partitions than
    ``defaultParallelism`` (a small table, or one file with one row group);
    a large scan already has many splits and is left alone.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target * factor)
    return df


def token_rows(df: DataFrame, text: str, keep: Sequence[str], out: str = "term") -> DataFrame:
    """One row per token of the whole text (empty pieces dropped after the
    explode, which keeps the filter inside generated code)."""
    return (df.select(*keep, F.explode(F.split(F.lower(F.col(text)), TOKEN_SPLIT)).alias(out))
            .filter(F.col(out) != ""))


def tokens(text: str | Column) -> Column:
    """Array of lower-case letter runs of the whole text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda x: F.length(x) > 0)


def ordered_join(df: DataFrame, group: Sequence[str], order_col: str, value_col: str,
                 sep: str, out: str) -> DataFrame:
    """Join ``value_col`` per group in ``order_col`` order with ``sep``.

    Collects one group into one row, so callers bound the group first (for
    example by a top-k); it is never applied to an unbounded group.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(value_col).alias("v"))))
    return df.groupBy(*group).agg(F.array_join(F.transform(pairs, lambda p: p["v"]), sep).alias(out))
