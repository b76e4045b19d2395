"""MERGE / upsert as a pure DataFrame function.

``merge_into`` returns the new target snapshot; persisting it (and only
the touched buckets) is ``strata.sources.store``'s job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGE_ACTION = "_merge_action"


@dataclass
class When:
    """One MERGE clause.

    ``matched``: True for WHEN MATCHED, False for WHEN NOT MATCHED.
    ``action``: 'update', 'delete' or 'insert'.
    ``condition``: extra predicate over ``s.*`` / ``t.*`` columns (NULL = not met).
    ``set``: column -> expression for update/insert (over ``s.*``/``t.*``).
    """

    matched: bool
    action: str
    condition: Column | None = None
    set: dict[str, Column] = field(default_factory=dict)


def merge_into(target: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[When],
               defaults: dict[str, Column] | None = None, with_action: bool = False) -> DataFrame:
    """Apply MERGE clauses; the first applicable clause wins for each row.

    Plan: one full-outer join of target and source on the keys (both sides
    shuffle once by key), then per-column CASE expressions. Rows with a NULL
    key match nothing; a hash of their values spreads them over the tasks. Target rows with
    no source row are kept unchanged; source rows with no applicable clause
    are dropped. Unassigned insert columns take ``defaults`` or NULL.
    """
    defaults = defaults or {}
    tcols = target.columns
    t = target.withColumn("_t", F.lit(True)).withColumn("_spread", _spread(target, keys)).alias("t")
    s = source.withColumn("_s", F.lit(True)).withColumn("_spread", _spread(source, keys)).alias("s")
    cond = F.col("t._spread") == F.col("s._spread")
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    j = t.join(s, cond, "full_outer")
    matched = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    src_only = F.col("t._t").isNull()

    # index of the first applicable clause (NULL when none applies)
    pick = None
    for i, cl in enumerate(clauses):
        base = matched if cl.matched else src_only
        ok = base & (F.coalesce(cl.condition, F.lit(False)) if cl.condition is not None else F.lit(True))
        pick = F.when(ok, F.lit(i)) if pick is None else pick.when(ok, F.lit(i))
    j = j.withColumn("_clause", pick if pick is not None else F.lit(None).cast("int"))

    out_cols = []
    for c in tcols:
        expr = F.col(f"t.{c}")
        for i, cl in enumerate(clauses):
            if cl.action == "update" and c in cl.set:
                expr = F.when(F.col("_clause") == i, cl.set[c]).otherwise(expr)
            elif cl.action == "insert":
                if c in cl.set:
                    val = cl.set[c]
                elif c in defaults:
                    val = defaults[c]
                else:
                    val = F.lit(None)
                expr = F.when(F.col("_clause") == i, val).otherwise(expr)
        out_cols.append(expr.cast(target.schema[c].dataType).alias(c))
    action = F.lit("unchanged")
    for i, cl in enumerate(clauses):
        action = F.when(F.col("_clause") == i, F.lit(cl.action)).otherwise(action)
    keep = (F.col("t._t").isNotNull() | F.col("_clause").isNotNull())
    deleted = F.lit(False)
    for i, cl in enumerate(clauses):
        if cl.action == "delete":
            deleted = deleted | F.coalesce(F.col("_clause") == i, F.lit(False))
    if with_action:
        return j.filter(keep).select(*out_cols, action.alias(MERGE_ACTION))
    return j.filter(keep & ~deleted).select(*out_cols)


def _spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 where the key is whole, else a hash of the row's plain values."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.when(has_null, F.xxhash64(*plain)).otherwise(F.lit(0).cast("long"))


def merge_counts(merged_with_action: DataFrame) -> DataFrame:
    """Rows affected per clause action (M02); ``rows_affected`` = all but unchanged."""
    a = F.col(MERGE_ACTION)
    return merged_with_action.agg(
        F.count(F.when(a == "insert", 1)).alias("rows_inserted"),
        F.count(F.when(a == "update", 1)).alias("rows_updated"),
        F.count(F.when(a == "delete", 1)).alias("rows_deleted"),
        F.count(F.when(a != "unchanged", 1)).alias("rows_affected"))


class DuplicateSourceKey(ValueError):
    pass


def assert_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key repeats in the source (Q04); stops at the first repeat."""
    dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateSourceKey(f"source repeats key {dict(zip(keys, dup[0][:len(keys)]))}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check_unique: bool = True) -> DataFrame:
    """Update-all / insert-all on a unique key."""
    if check_unique:
        assert_unique_keys(source, keys)
    src = sync_columns(source, target.columns, target.schema)
    values = {c: F.col(f"s.{c}") for c in target.columns}
    return merge_into(target, src, keys, [When(True, "update", set=values), When(False, "insert", set=values)])


def sync_columns(df: DataFrame, columns: Sequence[str], schema=None) -> DataFrame:
    """Project ``df`` onto ``columns``: missing ones become typed NULLs."""
    out = []
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        else:
            dtype = schema[c].dataType if schema is not None else "string"
            out.append(F.lit(None).cast(dtype).alias(c))
    return df.select(*out)


def sync_all_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """``on_schema_change='sync_all_columns'``: target takes the incoming column
    set — new columns added as typed NULLs, vanished ones dropped (M05)."""
    out = []
    for f in incoming.schema.fields:
        if f.name in target.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.select(*out)
