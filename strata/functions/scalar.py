"""Scalar column functions (F01-F17, X01) as built-in Column expressions.

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_lower(x: str | Column) -> Column:
    """``LOWER(TRIM(x))`` (F01). Spark's trim strips spaces only."""
    return F.lower(F.trim(_c(x)))


def strict_concat(*xs: str | Column) -> Column:
    """SQL ``a || b``: NULL when any side is NULL."""
    return F.concat(*[_c(x) for x in xs])


def mask_local_part(x: str | Column) -> Column:
    """``REGEXP_REPLACE(x, '.*@', '****@')`` (F03): greedy, up to the last '@'."""
    return F.regexp_replace(_c(x), ".*@", "****@")


def month_start(d: str | Column) -> Column:
    """``DATE_TRUNC('month', d)`` as a DATE."""
    return F.trunc(_c(d), "month")


def add_interval(ts: str | Column, unit: str, n: int) -> Column:
    """``DATEADD(unit, n, ts)``."""
    return F.timestamp_add(unit.upper(), F.lit(n), _c(ts))


def before_flag(d: str | Column, cutoff: str | Column) -> Column:
    """``(d < cutoff).astype(int)`` with NULL -> 0."""
    cut = F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    return F.coalesce((_c(d) < cut).cast("int"), F.lit(0))


def threshold_label(score: str | Column, cut: float, labels=("positive", "negative", "neutral")) -> Column:
    """Two cut points, three labels; strict inequalities."""
    s = _c(score)
    pos, neg, neu = labels
    return F.when(s > cut, pos).when(s < -cut, neg).otherwise(neu)


def classify_order_value(v: str | Column) -> Column:
    """Order value segment (X01): UNKNOWN / WHALE / HIGH / MEDIUM / LOW.

    NULL -> UNKNOWN. NaN compares false in Python, so it falls through to
    LOW; Spark orders NaN above every number, so NaN is tested first.
    """
    x = _c(v)
    # Cut points and labels of the reference's segment rule.
    return (F.when(x.isNull(), "UNKNOWN")
            .when(F.isnan(x), "LOW")
            .when(x >= 200, "WHALE")
            .when(x >= 100, "HIGH")
            .when(x >= 25, "MEDIUM")
            .otherwise("LOW"))


def contains_any(text: str | Column, words: Sequence[str]) -> Column:
    """``any(w in text.lower() for w in words)`` — substring, not token."""
    low = F.lower(_c(text))
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w.lower())
    return out


def first_matching_rule(text: str | Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Ordered keyword rules -> label, else ``default``."""
    expr = None
    for label, words in rules:
        cond = contains_any(text, words)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def sql_quote(x: str | Column) -> Column:
    """Escape single quotes for SQL literals: ``replace("'", "''")``."""
    return F.replace(_c(x), F.lit("'"), F.lit("''"))
