"""Table scans (S05) and the table inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one parquet table; filters/projections reach the reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_inventory(spark: SparkSession, sf_dir: str, schema: str = "testdata") -> DataFrame:
    """One row per table: (table_schema, table_name, row_count), ordered.

    Each count is a separate aggregate over a pruned scan (no columns read);
    the union is tiny.
    """
    parts = [
        table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(schema).alias("table_schema"), F.lit(t).alias("table_name"), "row_count")
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_schema", "table_name")
