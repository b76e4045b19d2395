"""Bronze -> silver -> gold pipeline of the dynamic-table lab.

The same three functions serve the batch pipeline and the streaming refresh
(``strata.streaming.dynamic``), which calls them on micro-batch slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.relational import latest_per_key, left_join_where
from strata.sources.derived import ORDERS_LATEST

BRONZE_COLS = ("order_id", "customer_id", "product_id", "quantity", "unit_price",
               "order_date", "status", "loaded_at")


def bronze(orders_raw: DataFrame, order_cols=ORDERS_LATEST) -> DataFrame:
    """Latest row per order_id (QUALIFY ROW_NUMBER() ... = 1)."""
    keep = list(BRONZE_COLS) + [c for c in order_cols if c not in BRONZE_COLS]
    return latest_per_key(orders_raw.select(*keep), ["order_id"], order_cols).select(*BRONZE_COLS)


def silver(bronze_df: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Enrich with the active customer's name and tier; line_total = qty * price.

    The dimension side is left to AQE: it is broadcast only when its runtime
    size is under ``spark.sql.autoBroadcastJoinThreshold``, else sort-merge.
    """
    dim = dim_customers.select("customer_id", F.col("name").alias("customer_name"),
                               F.col("tier").alias("customer_tier"), "is_active")
    j = left_join_where(bronze_df, dim, ["customer_id"], F.col("is_active") == F.lit(True))
    return j.select(
        "order_id", "order_date", "status", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        "customer_name", "customer_tier",
        "customer_id",
    )


def gold_aggregates():
    """Aggregates of the gold table, shared by batch and incremental refresh."""
    return [
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("line_total").cast("double").alias("lifetime_value"),
        (F.sum("line_total").cast("double") / F.count("line_total")).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    ]


def gold(silver_df: DataFrame) -> DataFrame:
    """Per (name, tier) metrics of non-cancelled orders; NULL keys form one group.

    ``status != 'CANCELLED'`` also drops NULL statuses (three-valued logic).
    The exact distinct count is planned as a two-level aggregate keyed first
    by (group, order_id), so a single hot group is spread over all tasks.
    """
    return (silver_df.filter(F.col("status") != "CANCELLED")
            .groupBy("customer_name", "customer_tier").agg(*gold_aggregates()))
