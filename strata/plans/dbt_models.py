"""The dbt project's models as DataFrame functions.

Staging models are views (inlined into the consumer's plan); marts are
tables; ``fct_orders`` is incremental (high-water filter, schema sync,
upsert on ``order_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import clean_lower
from strata.operators.merge import sync_all_columns, upsert
from strata.operators.relational import with_high_water
from strata.sources.store import BucketedTable


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """trimmed/lower-cased names and emails, upper-cased tier, non-null ids."""
    return raw_customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        clean_lower("name").alias("customer_name"),
        clean_lower("email").alias("customer_email"),
        F.upper("tier").alias("customer_tier"),
        "updated_at",
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Projection with non-null order ids (no dedup, as in the model)."""
    return raw_orders.filter(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_date", "status", "loaded_at")


def dim_customers(stg_c: DataFrame) -> DataFrame:
    """M08."""
    return stg_c.select("customer_id", "customer_name", "customer_email", "customer_tier", "updated_at")


def fct_orders_enrich(orders: DataFrame, stg_c: DataFrame) -> DataFrame:
    """The ``enriched`` CTE of fct_orders: left join customers, line_total."""
    c = stg_c.select("customer_id", "customer_name", "customer_tier")
    o = orders.alias("o")
    return o.join(c, "customer_id", "left").select(
        "order_id", "order_date", "customer_id", "customer_name", "customer_tier", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"), "status", "loaded_at")


def materialize(spark: SparkSession, df: DataFrame, name: str, mode: str, path: str | None = None,
                unique_key: tuple[str, ...] = (), buckets: int = 16) -> DataFrame:
    """``view`` (temp view), ``table`` (overwrite) or ``incremental``.

    Incremental: when the target exists, align it to the incoming columns
    (``sync_all_columns``) and upsert on ``unique_key`` — only the touched
    buckets are rewritten. Returns the materialised relation. ``buckets`` of a
    new table should make a bucket a few hundred MB; the table keeps its count.
    """
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode == "table":
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if mode != "incremental":
        raise ValueError(mode)
    store = BucketedTable(spark, path, unique_key, buckets, default_schema=df.schema)
    if not store.exists():
        store.write(df)
        return store.read()
    incoming_cols = df.columns
    if set(incoming_cols) != set(store.read().columns):
        # schema change rewrites every bucket, not just touched ones
        store.write(sync_all_columns(store.read(), df).checkpoint(eager=True))
    store.merge(df, lambda tgt, src: upsert(sync_all_columns(tgt, src), src, list(unique_key)))
    return store.read()


def fct_orders_run(spark: SparkSession, stg_o: DataFrame, stg_c: DataFrame, path: str,
                   dedup=None, buckets: int = 16) -> DataFrame:
    """One ``dbt run`` of fct_orders (M09): full load, or the incremental branch.

    ``dedup`` resolves repeated order ids in the new slice (the model itself
    does not, Q04); without it a repeat raises.
    """
    store = BucketedTable(spark, path, ("order_id",), buckets,
                          default_schema=fct_orders_enrich(stg_o.limit(0), stg_c).schema)
    orders = stg_o
    if store.exists():
        orders = with_high_water(stg_o, store.read(), "loaded_at")
    if dedup is not None:
        orders = dedup(orders)
    return materialize(spark, fct_orders_enrich(orders, stg_c), "fct_orders", "incremental", path,
                       unique_key=("order_id",), buckets=buckets)


def merge_customers(spark: SparkSession, feed: DataFrame, dim: BucketedTable, clauses, defaults,
                    batch_id=None) -> str:
    """The lab's stored procedure as a function.

    Gate on the change feed having data (C03), collapse it to one action per
    key (C04), MERGE it into the persisted dimension rewriting only touched
    buckets (M01), and report the affected row count (M02).
    """
    from strata.operators.cdc import collapse_feed, has_data
    from strata.operators.merge import MERGE_ACTION, merge_counts, merge_into

    if not has_data(feed).first().has_data:
        return "No new data in stream"
    src = collapse_feed(feed, dim.keys).checkpoint(eager=True)
    # the count comes from the same join the merge applies (clauses are deterministic), over the touched buckets only
    touched = dim.touched_partitions(src)
    target_part = dim.read_touched(src, touched).join(src.select(*dim.keys), dim.keys, "left_semi")
    n = merge_counts(merge_into(target_part, src, dim.keys, clauses, defaults, with_action=True)) \
        .first().rows_affected
    dim.merge(src, lambda t, s: merge_into(t, s, dim.keys, clauses, defaults), batch_id=batch_id, touched=touched)
    return f"Merge complete: {n} rows affected"
