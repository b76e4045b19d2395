"""Streaming dynamic tables, checked after the stream is drained
(S16, C05-C12): the raw orders arrive as ten slices hashed over all order
lines (so batches are out of event order), each slice drained by a restart
of the same checkpointed query; the layers must then equal the batch
pipeline over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path
from strata.sources import derived as D
from strata.sources import files
from strata.sources.derived import ORDERS_LATEST
from strata.sources.store import BucketedTable
from strata.streaming.dynamic import DynamicTables
from strata.streaming.layers import LayeredTables
from strata.streaming.stateful import drain_latest

SLICES = 10
ROWS_PER_BUCKET = 1_000_000


def write_slices(rows, number, path):
    """Write ``rows`` once, a folder ``slice=<number>`` per slice; the rows as written. Each task
    writes its part of every slice: the rows are not moved again, and a slice is read by many tasks."""
    rows.withColumn("slice", number).write.partitionBy("slice").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(path)


def drained_pipeline(spark, sf, change_dimension: bool = False) -> DynamicTables:
    """Build the three layers by streaming ``orders_raw`` in slices."""
    root = scratch_path(spark, "dynamic")
    src, waiting = f"{root}/_source", f"{root}/_slices"
    raw = write_slices(D.orders_raw(spark, sf), F.pmod(F.xxhash64("order_id", "line_no", "product_id", "supp_id"), F.lit(SLICES)), waiting)
    # buckets sized from the data, as a deployment would size them from its history
    buckets = max(2, -(-raw.count() // ROWS_PER_BUCKET))
    dt = DynamicTables(spark, root, D.customers(spark, sf), raw.schema, buckets=buckets)
    for i in range(SLICES):
        files.move(spark, f"{waiting}/slice={i}", f"{src}/{i}")  # new files land ...
        dt.run(src, f"{root}/_checkpoint", available_now=True)  # ... and are drained once
    if change_dimension:
        dt.on_dimension_change(changed_dimension(spark, sf), "1")
    return dt


def changed_dimension(spark, sf):
    c = D.customers(spark, sf)
    return c.select(
        "customer_id", "name", "email",
        F.when(F.col("customer_id") % 5 == 0, "gold").otherwise(F.col("tier")).alias("tier"),
        (F.col("is_active") & (F.col("customer_id") % 7 != 0)).alias("is_active"), "region")


@register("c05_c06_s16_stream_bronze", with_("bronze") + "SELECT * FROM bronze")
def c06(spark, sf):
    from strata.plans.medallion import BRONZE_COLS

    return drained_pipeline(spark, sf).bronze.read().select(*BRONZE_COLS)


@register("c07_stream_silver", with_("silver") + "SELECT * FROM silver")
def c07(spark, sf):
    return drained_pipeline(spark, sf).silver.read()


@register("c08_c10_c11_stream_gold", with_("gold") + "SELECT * FROM gold")
def c08(spark, sf):
    return drained_pipeline(spark, sf).gold_table()


_CHANGED_DIM_SQL = """
SELECT customer_id, name, email, CASE WHEN customer_id % 5 = 0 THEN 'gold' ELSE tier END AS tier,
       is_active AND customer_id % 7 <> 0 AS is_active, region FROM customers"""


@register("c12_dimension_change_refresh", with_("bronze", "customers", extra={
    "customers2": _CHANGED_DIM_SQL,
    "silver2": """
SELECT o.order_id, o.order_date, o.status, o.quantity, o.unit_price, o.quantity * o.unit_price AS line_total,
       c.name AS customer_name, c.tier AS customer_tier, o.customer_id
FROM bronze o LEFT JOIN customers2 c ON o.customer_id = c.customer_id AND c.is_active = TRUE"""}) + """
SELECT customer_name, customer_tier, COUNT(DISTINCT order_id) AS total_orders,
       CAST(SUM(line_total) AS DOUBLE) AS lifetime_value,
       CAST(SUM(line_total) AS DOUBLE) / COUNT(line_total) AS avg_order_value,
       MAX(order_date) AS last_order_date
FROM silver2 WHERE status <> 'CANCELLED' GROUP BY customer_name, customer_tier""")
def c12(spark, sf):
    return drained_pipeline(spark, sf, change_dimension=True).gold_table()


# ----------------------------------------- layers with offsets of their own --

_HALVES_SQL = {
    "customers2": _CHANGED_DIM_SQL,
    "changes": "SELECT * FROM customers2 WHERE customer_id % 5 = 0 OR customer_id % 7 = 0",
    "halves": "SELECT order_id, customer_id, (order_id + line_no) % 2 AS half FROM orders_raw",
    "silver2": """
SELECT o.order_id, o.order_date, o.status, o.quantity * o.unit_price AS line_total, c.name AS customer_name, c.tier AS customer_tier
FROM bronze o LEFT JOIN customers2 c ON o.customer_id = c.customer_id AND c.is_active = TRUE""",
    "gold2": """
SELECT customer_name, customer_tier, COUNT(DISTINCT order_id) AS total_orders, CAST(SUM(line_total) AS DOUBLE) AS lifetime_value,
       CAST(SUM(line_total) AS DOUBLE) / COUNT(line_total) AS avg_order_value, MAX(order_date) AS last_order_date
FROM silver2 WHERE status <> 'CANCELLED' GROUP BY customer_name, customer_tier""",
}


def layered(spark, sf):
    """Empty layers, and functions that land half of the orders (0 or 1) and
    the customer changelog's first load (0) or its later changes (1)."""
    root = scratch_path(spark, "layers")
    raw = write_slices(D.orders_raw(spark, sf), (F.col("order_id") + F.col("line_no")) % 2, f"{root}-halves")
    first, later = D.customers(spark, sf).withColumn("seq", F.lit(0)), changed_dimension(spark, sf).withColumn("seq", F.lit(1))
    later = later.filter("customer_id % 5 = 0 OR customer_id % 7 = 0")
    buckets = max(2, -(-raw.count() // ROWS_PER_BUCKET))
    layers = LayeredTables(spark, root, raw.schema, first.schema, buckets=buckets)

    def land(half: int, changes: int) -> None:
        files.move(spark, f"{root}-halves/slice={half}", f"{root}/log/orders/half-{half}")
        layers.land("customers", (first, later)[changes], f"changes-{changes}")

    return layers, land


def pulled_twice(spark, sf):
    """Gold asked for twice, with new orders and customer changes between."""
    layers, land = layered(spark, sf)
    land(0, 0)
    layers.refresh("gold")
    land(1, 1)
    layers.refresh("gold")
    return layers


@register("c09_layer_freshness", with_("gold", "customers", extra=_HALVES_SQL) + """
SELECT 'bronze' AS layer, 60 AS target_seconds, 2 AS available, 2 AS consumed, 0 AS pending, (SELECT COUNT(*) FROM bronze) AS rows, TRUE AS lag_measured
UNION ALL SELECT 'silver', 120, 4, 4, 0, (SELECT COUNT(*) FROM silver2), TRUE
UNION ALL SELECT 'gold', NULL, 2, 2, 0, (SELECT COUNT(*) FROM gold2), TRUE""")
def c09(spark, sf):
    status = pulled_twice(spark, sf).status()
    return status.select("layer", "target_seconds", "available", "consumed", "pending", "rows", (F.col("lag_seconds") >= 0).alias("lag_measured"))


@register("c10_refresh_on_demand", with_("bronze", "customers", extra={**_HALVES_SQL, "second": """
SELECT DISTINCT order_id FROM halves WHERE half = 1 OR customer_id IN (SELECT customer_id FROM changes)"""}) + """
SELECT 'bronze' AS layer, half AS pull, 1 AS changes, COUNT(*) AS rows FROM halves GROUP BY half
UNION ALL SELECT 'silver', half, 2, COUNT(DISTINCT order_id) + CASE half WHEN 0 THEN (SELECT COUNT(*) FROM customers) ELSE (SELECT COUNT(*) FROM changes) END
FROM halves GROUP BY half
UNION ALL SELECT 'gold', 0, 1, COUNT(DISTINCT order_id) FROM halves WHERE half = 0
UNION ALL SELECT 'gold', 1, 1, (SELECT COUNT(*) FROM second) + (SELECT COUNT(*) FROM second WHERE order_id IN (SELECT order_id FROM halves WHERE half = 0))""")
def c10(spark, sf):
    """What each pull of gold consumed in each layer: the second only what came since the first."""
    return pulled_twice(spark, sf).refreshes().select("layer", F.col("batch_id").alias("pull"), F.size("entries").alias("changes"), "rows")


@register("c10_c12_pulled_gold", with_("bronze", "customers", extra=_HALVES_SQL) + "SELECT * FROM gold2")
def c10_gold(spark, sf):
    return pulled_twice(spark, sf).read("gold")


@register("c12_dimension_as_stream_input", with_("bronze", "customers", extra=_HALVES_SQL) + "SELECT * FROM gold2")
def c12_stream(spark, sf):
    """Orders and customer changes in one query, the later changes first, with a restart between."""
    layers, land = layered(spark, sf)
    land(1, 1)
    layers.refresh_together()
    land(0, 0)
    layers.refresh_together()
    return layers.read("gold")


@register("c06_stateful_latest", with_("bronze") + "SELECT * FROM bronze")
def c06_stateful(spark, sf):
    """Bronze kept by a streaming aggregate, restarted between the slices."""
    from strata.plans.medallion import BRONZE_COLS

    root = scratch_path(spark, "stateful")
    raw = write_slices(D.orders_raw(spark, sf), F.pmod(F.xxhash64("order_id", "line_no"), F.lit(3)), f"{root}/waiting")
    table = BucketedTable(spark, f"{root}/bronze", ["order_id"], max(2, -(-raw.count() // ROWS_PER_BUCKET)), raw.schema)
    for i in (2, 0, 1):
        files.move(spark, f"{root}/waiting/slice={i}", f"{root}/in/{i}")
        stream = spark.readStream.schema(raw.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        drain_latest(stream, table, ORDERS_LATEST, f"{root}/checkpoint")
    return table.read().select(*BRONZE_COLS)
