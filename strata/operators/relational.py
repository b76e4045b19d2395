"""Relational building blocks: projections, filters, joins, windows, top-k.

Every function maps DataFrames to a DataFrame and uses only built-in
expressions, so Catalyst can push filters into scans, prune columns and keep
the work inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs: Iterable[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ---------------------------------------------------------------- windows --

def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key: the greatest by ``order_desc``.

    ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ... DESC) = 1``
    with SQL's default null placement for DESC: NULLS FIRST (Q12), so a row
    with a NULL ordering value counts as the latest.
    The order list must be total, otherwise the kept row is arbitrary (Q02).
    Spark plans this as a partial WindowGroupLimit before the shuffle, so a
    hot key is cut to one row per map task before it is exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_first() for c in _cols(order_desc)])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group by a total order (O05); adds a 1-based rank."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def running_total(df: DataFrame, group: str | Sequence[str], order: Sequence[str | Column], value: str,
                  partitions: int | None = None) -> DataFrame:
    """Per-group running sum in ``order`` without one task per group.

    Range-partition on (group, order) so even a group holding a third of all
    rows is split evenly; sum each (range partition, group) slice; prefix-sum
    the slice totals (a table of partitions x groups rows); add that offset
    to the running sum inside each slice. ``partitions`` defaults to
    ``spark.sql.shuffle.partitions`` (sized for the data like any shuffle).
    """
    groups = [group] if isinstance(group, str) else list(group)
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = (df.repartitionByRange(partitions, *groups, *order)
             .withColumn("_pid", F.spark_partition_id()))
    keyed = keyed.checkpoint(eager=True)  # fixes the partition ids against recomputation
    slice_tot = keyed.groupBy("_pid", *groups).agg(F.sum(value).alias("_slice"))
    w_off = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    keys = ["_pid", *groups]
    offsets = slice_tot.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                               F.coalesce(F.sum("_slice").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy("_pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumn("_run", F.sum(value).over(w_in))
    on = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"_o{i}"))
        on = c if on is None else on & c
    return (local.join(offsets, on).drop(*[f"_o{i}" for i in range(len(keys))])
            .withColumn("running_total", F.col("_off") + F.col("_run")).drop("_pid", "_off", "_run"))


def rank_within(df: DataFrame, partition: Sequence[str], value: str, name: str, descending: bool = True,
                skew_safe: bool = True) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition ORDER BY value [DESC])``.

    A plain window sorts a whole partition in one task, so one partition
    holding a third of all rows would be one task. The skew-safe form uses
    rank = 1 + rows that sort strictly before the value: count rows per
    (partition, value) (map-side partial counts), take a range-partitioned
    running total of those counts, and join the ranks back on (partition,
    value). NULL values sort last, as in the window.
    """
    order = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_first()
    if not skew_safe:
        w_order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
        return df.withColumn(name, F.rank().over(Window.partitionBy(*partition).orderBy(w_order)))
    counts = df.groupBy(*partition, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    run = running_total(counts, list(partition), [order], "_n")
    keys = [*partition, "_v"]
    ranks = run.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                       (F.col("running_total") - F.col("_n") + 1).cast("int").alias(name))
    on = None
    for i, k in enumerate([*partition, value]):
        c = F.col(k).eqNullSafe(F.col(f"_r{i}"))
        on = c if on is None else on & c
    return df.join(ranks, on).drop(*[f"_r{i}" for i in range(len(keys))])


# ---------------------------------------------------------------- joins ----

def left_join_where(left: DataFrame, right: DataFrame, keys: Sequence[str], right_condition: Column) -> DataFrame:
    """LEFT JOIN with an extra right-side predicate in ON.

    Filtering the right side first is equivalent (unmatched and filtered-out
    rows both give NULLs) and lets the predicate reach the right-side scan.
    """
    return left.join(right.filter(right_condition), list(keys), "left")


def with_high_water(df: DataFrame, target: DataFrame, ts_col: str) -> DataFrame:
    """Rows strictly newer than ``max(ts_col)`` of the target.

    The max is read first and goes into the filter as a literal, so that it
    reaches the source's scan (and prunes its files or partitions). An empty
    target (NULL max) loads everything (documented deviation Q05).
    """
    kind = df.schema[ts_col].dataType
    high = target.agg(F.max(F.col(ts_col).cast(kind)).cast("string")).first()[0]
    return df if high is None else df.filter(F.col(ts_col) > F.lit(high).cast(kind))


# ----------------------------------------------------------- DML snapshots --

def update_where(df: DataFrame, predicate: Column, **assignments: Column) -> DataFrame:
    """``UPDATE t SET c = expr WHERE p`` as a new snapshot (P12). NULL p = no change."""
    cond = F.coalesce(predicate, F.lit(False))
    out = df
    for name, expr in assignments.items():
        out = out.withColumn(name, F.when(cond, expr).otherwise(F.col(name)))
    return out


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE FROM t WHERE p`` as a new snapshot (P13). NULL p keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def add_column_if_absent(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """``ALTER TABLE .. ADD COLUMN IF NOT EXISTS`` (S11): typed NULLs."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def append_with_defaults(target_schema, rows: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT INTO t(cols) ...`` (S08/S10): fill unnamed columns from defaults.

    Returns the rows aligned to ``target_schema`` (a StructType), ready for
    ``write.mode('append')``.
    """
    defaults = defaults or {}
    out = []
    for f in target_schema.fields:
        if f.name in rows.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            out.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rows.select(*out)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name (U01); missing columns become NULL."""
    return a.unionByName(b, allowMissingColumns=True)
