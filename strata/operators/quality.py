"""Data-quality checks (D01-D04) in the shape of dbt schema tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows; the test passes when this is empty."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values with their counts (NULLs are ignored).

    groupBy with map-side partial counts: a hot value is pre-aggregated per
    task before the shuffle.
    """
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def run_checks(tables: dict[str, DataFrame], checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(check, table, column)`` -> one row with the failure count.

    not_null checks of one table share a single aggregate pass; each unique
    check is one grouped count.
    """
    results = []
    by_table: dict[str, list[str]] = {}
    for check, tname, col in checks:
        if check == "not_null":
            by_table.setdefault(tname, []).append(col)
        elif check != "unique":
            raise ValueError(check)
    for tname, cols in by_table.items():
        agg = tables[tname].agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
        for c in cols:
            results.append(agg.select(F.lit("not_null").alias("check_name"), F.lit(tname).alias("table_name"),
                                      F.lit(c).alias("column_name"), F.col(c).cast("long").alias("failures")))
    for check, tname, col in checks:
        if check == "unique":
            f = unique_failures(tables[tname], col).agg(F.count(F.lit(1)).alias("failures"))
            results.append(f.select(F.lit("unique").alias("check_name"), F.lit(tname).alias("table_name"),
                                    F.lit(col).alias("column_name"), F.col("failures").cast("long")))
    return reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
