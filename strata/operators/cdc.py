"""Change data capture by snapshot diff.

A table "stream" is the net difference between the snapshot last consumed
and the current one: INSERT rows for new or changed keys, DELETE rows for
removed or changed keys; a change yields DELETE (old values) plus INSERT
(new values), both flagged ``is_update``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.relational import latest_per_key

ACTION = "metadata_action"
IS_UPDATE = "metadata_isupdate"


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str] | None,
                update_key: Sequence[str] | None = None) -> DataFrame:
    """Net change feed from ``old`` to ``new`` with action and is-update columns.

    The bag difference of the two snapshots: whole rows are counted +1 (new)
    and -1 (old) in one partial aggregate, so rows that both hold cancel
    whatever their key is (NULL and repeated keys included), and a hot row is
    pre-aggregated. A change is an update when its key (``update_key``, else
    ``keys``) has both an INSERT and a DELETE; without any key it is not.
    """
    cols = [c for c in new.columns]
    # a column added since the old snapshot (ADD COLUMN) reads as NULL there; dropped ones are ignored
    old = old.select(*[F.col(c) if c in old.columns else F.lit(None).cast(new.schema[c].dataType).alias(c)
                       for c in cols])
    net = (new.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1)))
           .groupBy(*cols).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0))
    action = F.when(F.col("_n") > 0, F.lit("INSERT")).otherwise(F.lit("DELETE"))
    feed = net.withColumn(ACTION, action).withColumn("_n", F.explode(F.sequence(F.lit(1), F.abs("_n")))).drop("_n")
    by = list(update_key or keys or [])
    if not by:
        return feed.withColumn(IS_UPDATE, F.lit(False))
    flags = feed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)]).agg(
        (F.min(ACTION) != F.max(ACTION)).alias(IS_UPDATE))
    cond = F.lit(True)
    for i, k in enumerate(by):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return feed.join(flags, cond).select(*cols, ACTION, IS_UPDATE)


def has_data(feed: DataFrame) -> DataFrame:
    """Has-data test of a change stream as a one-row frame (C03); reads one row at most."""
    return feed.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_data"))


def collapse_feed(feed: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """One change per key, INSERT preferred over DELETE.

    'INSERT' > 'DELETE' as strings, so ``action DESC`` keeps the insert of an
    update pair. ``tiebreak`` makes the order total for raw change logs.
    """
    return latest_per_key(feed, keys, [ACTION, *tiebreak])
