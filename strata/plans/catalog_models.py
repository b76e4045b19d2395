"""CDC, MERGE, dbt models, customer metrics, UDF path and quality checks
(C01-C04, M01-M10, A11, X01-X06, D01-D04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import scalar as S
from strata.functions.udfs import register_classify_udf
from strata.operators import cdc
from strata.operators import quality as Q
from strata.operators.merge import When, merge_counts, merge_into, sync_all_columns, upsert
from strata.operators.relational import latest_per_key
from strata.plans import dbt_models as dbt
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path
from strata.sources import derived as D
from strata.sources.change_stream import ChangeStream
from strata.sources.derived import ORDERS_LATEST
from strata.sources.store import BucketedTable

T0 = "2024-01-01 00:00:00"      # loaded_at of the initial dimension load
T1 = "2024-02-01 00:00:00"      # CURRENT_TIMESTAMP() of the merge run
FCT_CUT = "1996-06-30 00:00:00"  # first dbt run sees orders loaded up to here


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# --------------------------------------------------------- two snapshots --

_SNAP_SQL = {
    "old_snap": "SELECT customer_id, name, email, tier FROM customers",
    "new_snap": """
SELECT customer_id, name, email, CASE WHEN customer_id % 7 = 0 THEN 'platinum' ELSE tier END AS tier
FROM customers WHERE customer_id % 11 <> 0
UNION ALL
SELECT customer_id + 1000000 AS customer_id, name || ' II' AS name, email, tier
FROM customers WHERE customer_id % 13 = 0""",
}
_FEED_SQL = {
    "j": """
SELECT o.customer_id AS o_id, o.name AS o_name, o.email AS o_email, o.tier AS o_tier,
       n.customer_id AS n_id, n.name AS n_name, n.email AS n_email, n.tier AS n_tier,
       (o.name IS DISTINCT FROM n.name OR o.email IS DISTINCT FROM n.email
        OR o.tier IS DISTINCT FROM n.tier) AS differs
FROM old_snap o FULL OUTER JOIN new_snap n ON o.customer_id = n.customer_id""",
    "feed": """
SELECT o_id AS customer_id, o_name AS name, o_email AS email, o_tier AS tier,
       'DELETE' AS metadata_action, n_id IS NOT NULL AS metadata_isupdate
FROM j WHERE o_id IS NOT NULL AND (n_id IS NULL OR differs)
UNION ALL
SELECT n_id, n_name, n_email, n_tier, 'INSERT', o_id IS NOT NULL
FROM j WHERE n_id IS NOT NULL AND (o_id IS NULL OR differs)""",
}


def _snapshots(spark, sf):
    c = D.customers(spark, sf)
    old = c.select("customer_id", "name", "email", "tier")
    changed = c.filter(F.col("customer_id") % 11 != 0).select(
        "customer_id", "name", "email",
        F.when(F.col("customer_id") % 7 == 0, "platinum").otherwise(F.col("tier")).alias("tier"))
    added = c.filter(F.col("customer_id") % 13 == 0).select(
        (F.col("customer_id") + 1000000).alias("customer_id"),
        F.concat("name", F.lit(" II")).alias("name"), "email", "tier")
    return old, changed.unionByName(added)


def _feed(spark, sf):
    old, new = _snapshots(spark, sf)
    return cdc.change_feed(old, new, ["customer_id"])


@register("c01_c02_change_feed", with_("customers", extra={**_SNAP_SQL, **_FEED_SQL}) + "SELECT * FROM feed")
def c01(spark, sf):
    return _feed(spark, sf)


@register("c01_keyless_change_feed", with_("customers", extra=_SNAP_SQL) + """
SELECT *, 'INSERT' AS metadata_action, customer_id IN (SELECT customer_id FROM old_snap) AS metadata_isupdate FROM (
  SELECT * FROM new_snap EXCEPT ALL SELECT * FROM old_snap)
UNION ALL
SELECT *, 'DELETE', customer_id IN (SELECT customer_id FROM new_snap)
FROM (SELECT * FROM old_snap EXCEPT ALL SELECT * FROM new_snap)""")
def c01_keyless(spark, sf):
    old, new = _snapshots(spark, sf)
    return cdc.change_feed(old, new, None, update_key=["customer_id"])


@register("c03_stream_has_data", with_("customers", extra={**_SNAP_SQL, **_FEED_SQL}) +
          "SELECT (SELECT COUNT(*) FROM feed) > 0 AS has_data")
def c03(spark, sf):
    return cdc.has_data(_feed(spark, sf))


_COLLAPSED_SQL = {"src": """
SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY metadata_action DESC NULLS FIRST) = 1"""}


@register("c04_collapse_feed", with_("customers", extra={**_SNAP_SQL, **_FEED_SQL, **_COLLAPSED_SQL}) +
          "SELECT * FROM src")
def c04(spark, sf):
    return cdc.collapse_feed(_feed(spark, sf), ["customer_id"])


# ------------------------------------------------------------------ MERGE --

def _dim_target(spark, sf):
    return D.customers(spark, sf).select("customer_id", "name", "email", "tier", "is_active",
                                         _ts(T0).alias("loaded_at"))


def lab_merge_clauses():
    """The three WHEN clauses of the customer merge procedure."""
    return [
        When(True, "update", F.col("s.metadata_action") == "DELETE", {"is_active": F.lit(False)}),
        When(True, "update", F.col("s.metadata_action") == "INSERT",
             {"name": F.col("s.name"), "email": F.col("s.email"), "tier": F.col("s.tier"),
              "loaded_at": _ts(T1)}),
        When(False, "insert", F.col("s.metadata_action") == "INSERT",
             {"customer_id": F.col("s.customer_id"), "name": F.col("s.name"), "email": F.col("s.email"),
              "tier": F.col("s.tier")}),
    ]


def lab_merge_defaults():
    return {"is_active": F.lit(True), "loaded_at": _ts(T1)}

_MERGE_SQL = {
    "tgt": f"SELECT customer_id, name, email, tier, is_active, TIMESTAMP '{T0}' AS loaded_at FROM customers",
    "mj": """
SELECT t.customer_id, t.name, t.email, t.tier, t.is_active, t.loaded_at,
       t.customer_id IS NOT NULL AS t_present, s.customer_id AS s_id, s.name AS s_name,
       s.email AS s_email, s.tier AS s_tier, s.metadata_action AS act
FROM tgt t FULL OUTER JOIN src s ON t.customer_id = s.customer_id""",
    "merged": f"""
SELECT CASE WHEN t_present THEN customer_id ELSE s_id END AS customer_id,
       CASE WHEN t_present AND act = 'INSERT' THEN s_name WHEN t_present THEN name ELSE s_name END AS name,
       CASE WHEN t_present AND act = 'INSERT' THEN s_email WHEN t_present THEN email ELSE s_email END AS email,
       CASE WHEN t_present AND act = 'INSERT' THEN s_tier WHEN t_present THEN tier ELSE s_tier END AS tier,
       CASE WHEN t_present AND act = 'DELETE' THEN FALSE WHEN t_present THEN is_active ELSE TRUE END AS is_active,
       CASE WHEN t_present AND act = 'INSERT' THEN TIMESTAMP '{T1}' WHEN t_present THEN loaded_at
            ELSE TIMESTAMP '{T1}' END AS loaded_at,
       CASE WHEN t_present AND act IS NOT NULL THEN 'update'
            WHEN NOT t_present AND act = 'INSERT' THEN 'insert' ELSE 'unchanged' END AS merge_action
FROM mj WHERE t_present OR act = 'INSERT'""",
}
_MERGE_ALL = {**_SNAP_SQL, **_FEED_SQL, **_COLLAPSED_SQL, **_MERGE_SQL}


def _lab_merge(spark, sf, with_action=False):
    src = cdc.collapse_feed(_feed(spark, sf), ["customer_id"])
    return merge_into(_dim_target(spark, sf), src, ["customer_id"], lab_merge_clauses(),
                      lab_merge_defaults(), with_action=with_action)


@register("m01_j09_merge_conditional", with_("customers", extra=_MERGE_ALL) +
          "SELECT customer_id, name, email, tier, is_active, loaded_at FROM merged")
def m01(spark, sf):
    return _lab_merge(spark, sf)


@register("m02_x06_merge_row_count", with_("customers", extra=_MERGE_ALL) + """
SELECT COUNT(*) FILTER (WHERE merge_action = 'insert') AS rows_inserted,
       COUNT(*) FILTER (WHERE merge_action = 'update') AS rows_updated,
       CAST(0 AS BIGINT) AS rows_deleted,
       COUNT(*) FILTER (WHERE merge_action <> 'unchanged') AS rows_affected,
       'Merge complete: ' || COUNT(*) FILTER (WHERE merge_action <> 'unchanged') || ' rows affected' AS message
FROM merged""")
def m02(spark, sf):
    c = merge_counts(_lab_merge(spark, sf, with_action=True))
    return c.withColumn("message", F.concat(F.lit("Merge complete: "), F.col("rows_affected").cast("string"),
                                            F.lit(" rows affected")))


@register("c01_c05_x06_stored_change_stream", with_("customers", extra=_MERGE_ALL) + """
SELECT customer_id, name, email, tier, is_active, loaded_at,
       'Merge complete: ' || (SELECT COUNT(*) FILTER (WHERE merge_action <> 'unchanged') FROM merged) || ' rows affected' AS first_call,
       'No new data in stream' AS second_call
FROM merged""")
def c05_stored(spark, sf):
    """The merge procedure called twice on a stream that stores its offset:
    the second call finds nothing left to consume."""
    old, new = _snapshots(spark, sf)
    root = scratch_path(spark, "customer-stream")
    dim = BucketedTable(spark, f"{root}/dim", ["customer_id"])
    dim.write(_dim_target(spark, sf))
    stream = ChangeStream(spark, f"{root}/stream", ["customer_id"]).create(old)

    def merge(feed, batch_id):
        return dbt.merge_customers(spark, feed, dim, lab_merge_clauses(), lab_merge_defaults(), batch_id)

    first, second = stream.consume(new, merge), stream.consume(new, merge)
    return dim.read().select("*", F.lit(first).alias("first_call"), F.lit(second).alias("second_call"))


@register("s16_c01_digest_change_feed", with_("customers", extra={**_SNAP_SQL, **_FEED_SQL}) + "SELECT * FROM feed")
def s16_digest(spark, sf):
    """The change feed through a stored stream that compares only the buckets whose digest differs."""
    old, new = _snapshots(spark, sf)
    root = scratch_path(spark, "digest-stream")
    ChangeStream(spark, f"{root}/stream", ["customer_id"]).create(old).consume(
        new, lambda feed, batch_id: feed.write.parquet(f"{root}/{batch_id}"))
    return spark.read.parquet(f"{root}/offset-1")


@register("s16_changed_buckets_per_call", with_("customers", extra={"first_id": "SELECT min(customer_id) AS id FROM customers"}) + """
SELECT 1 AS call, 0 AS buckets_compared, CAST(0 AS BIGINT) AS inserts, CAST(0 AS BIGINT) AS deletes
UNION ALL
SELECT 2, count(DISTINCT customer_id)::INT, count(*), count(*) FROM customers, first_id WHERE customer_id = id
UNION ALL
SELECT 3, 0, 0, 0
UNION ALL
SELECT 4, count(DISTINCT customer_id)::INT, CAST(0 AS BIGINT), count(*) FROM customers, first_id WHERE customer_id = id""")
def s16_changed(spark, sf):
    """Four calls of a stream: nothing new, one customer changed, nothing new, that
    customer gone. Only the customer's bucket is compared."""
    old, _ = _snapshots(spark, sf)
    one = F.col("customer_id") == F.lit(old.agg(F.min("customer_id")).first()[0])
    changed = old.withColumn("tier", F.when(one, F.lit("moved")).otherwise(F.col("tier")))
    stream = ChangeStream(spark, scratch_path(spark, "digest-stream"), ["customer_id"]).create(old)

    def count(feed, batch_id):
        return feed.agg(F.count_if(F.col(cdc.ACTION) == "INSERT"), F.count_if(F.col(cdc.ACTION) == "DELETE")).first()

    calls = []
    for number, state in enumerate([old, changed, changed, changed.filter(~one)], 1):
        inserts, deletes = stream.consume(state, count)
        calls.append((number, len(stream.changed), inserts, deletes))
    return spark.createDataFrame(calls, "call int, buckets_compared int, inserts long, deletes long")


@register("m04_upsert_unique_key", with_("customers", extra={**_SNAP_SQL, **_FEED_SQL}) + """
SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
       CASE WHEN s.customer_id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.customer_id IS NOT NULL THEN s.email ELSE t.email END AS email,
       CASE WHEN s.customer_id IS NOT NULL THEN s.tier ELSE t.tier END AS tier
FROM old_snap t FULL OUTER JOIN
     (SELECT customer_id, name, email, tier FROM feed WHERE metadata_action = 'INSERT') s
  ON t.customer_id = s.customer_id""")
def m04(spark, sf):
    old, _ = _snapshots(spark, sf)
    ins = _feed(spark, sf).filter(F.col(cdc.ACTION) == "INSERT").select("customer_id", "name", "email", "tier")
    return upsert(old, ins, ["customer_id"])


@register("m05_schema_sync", with_("customers", extra=_SNAP_SQL) + """
SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
       CASE WHEN s.customer_id IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.customer_id IS NOT NULL THEN s.tier ELSE t.tier END AS tier,
       s.region AS region
FROM old_snap t FULL OUTER JOIN
     (SELECT customer_id, name, 'gold' AS tier, region FROM customers WHERE customer_id % 7 = 0) s
  ON t.customer_id = s.customer_id""")
def m05(spark, sf):
    old, _ = _snapshots(spark, sf)
    incoming = D.customers(spark, sf).filter(F.col("customer_id") % 7 == 0).select(
        "customer_id", "name", F.lit("gold").alias("tier"), "region")
    return upsert(sync_all_columns(old, incoming), incoming, ["customer_id"])


# ------------------------------------------------------------ dbt models --

_RAW_CUSTOMERS_SQL = {"raw_customers": f"""
SELECT customer_id, '  ' || name || ' ' AS name, upper(email) AS email, tier,
       TIMESTAMP '{T0}' AS updated_at FROM customers"""}
_STG_SQL = {
    "stg_customers": """
SELECT customer_id, lower(trim(name)) AS customer_name, lower(trim(email)) AS customer_email,
       upper(tier) AS customer_tier, updated_at FROM raw_customers WHERE customer_id IS NOT NULL""",
    "stg_orders": """
SELECT order_id, customer_id, product_id, quantity, unit_price, order_date, status, loaded_at
FROM orders_raw WHERE order_id IS NOT NULL""",
}


def _raw_customers(spark, sf):
    c = D.customers(spark, sf)
    return c.select("customer_id", F.concat(F.lit("  "), "name", F.lit(" ")).alias("name"),
                    F.upper("email").alias("email"), "tier", _ts(T0).alias("updated_at"))


@register("m06_p11_stg_customers", with_("customers", extra={**_RAW_CUSTOMERS_SQL, **_STG_SQL}) +
          "SELECT * FROM stg_customers")
def m06(spark, sf):
    return dbt.stg_customers(_raw_customers(spark, sf))


@register("m07_stg_orders", with_("orders_raw", "customers", extra={**_RAW_CUSTOMERS_SQL, **_STG_SQL}) +
          "SELECT * FROM stg_orders")
def m07(spark, sf):
    return dbt.stg_orders(D.orders_raw(spark, sf))


@register("m08_m10_dim_customers_table", with_("customers", extra={**_RAW_CUSTOMERS_SQL, **_STG_SQL}) +
          "SELECT customer_id, customer_name, customer_email, customer_tier, updated_at FROM stg_customers")
def m08(spark, sf):
    df = dbt.dim_customers(dbt.stg_customers(_raw_customers(spark, sf)))
    return dbt.materialize(spark, df, "dim_customers", "table", scratch_path(spark, "dim_customers"))


@register("m09_j03_fct_orders_incremental",
          with_("orders_raw", "customers", extra={**_RAW_CUSTOMERS_SQL, **_STG_SQL}) + """
SELECT o.order_id, o.order_date, o.customer_id, c.customer_name, c.customer_tier, o.quantity, o.unit_price,
       CAST(o.quantity * o.unit_price AS DECIMAL(23,2)) AS line_total, o.status, o.loaded_at
FROM (SELECT * FROM orders_raw QUALIFY row_number() OVER (
        PARTITION BY order_id ORDER BY loaded_at DESC NULLS FIRST, line_no DESC NULLS FIRST,
                                     product_id DESC NULLS FIRST, supp_id DESC NULLS FIRST) = 1) o
LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""")
def m09(spark, sf):
    raw = D.orders_raw(spark, sf)
    stg_c = dbt.stg_customers(_raw_customers(spark, sf))
    path = scratch_path(spark, "fct_orders")

    def dedup(df):
        return latest_per_key(df, ["order_id"], ORDERS_LATEST).drop("line_no", "supp_id")

    # the staging view carries the tie-break columns through to the dedup
    stg_o = raw.filter(F.col("order_id").isNotNull())
    first = stg_o.filter(F.col("loaded_at") <= _ts(FCT_CUT))
    dbt.fct_orders_run(spark, first, stg_c, path, dedup=dedup)        # full load
    return dbt.fct_orders_run(spark, stg_o, stg_c, path, dedup=dedup)  # incremental run


# ------------------------------------------------------- customer metrics --

_METRICS_SQL = {"customer_metrics": """
SELECT m.customer_id, m.total_orders, m.total_spent, m.avg_order_value, m.last_order_date, c.name, c.tier
FROM (SELECT customer_id, COUNT(order_id) AS total_orders, CAST(SUM(unit_price) AS DOUBLE) AS total_spent,
             CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_order_value,
             MAX(order_date) AS last_order_date
      FROM orders_raw GROUP BY customer_id) m
LEFT JOIN customers c USING (customer_id)
ORDER BY total_spent DESC"""}


def customer_metrics(spark, sf):
    """Per-customer order metrics joined to name and tier (total_spent sums unit_price, Q11)."""
    o = D.orders_raw(spark, sf)
    m = o.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("unit_price").cast("double").alias("total_spent"),
        (F.sum("unit_price").cast("double") / F.count("unit_price")).alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"))
    c = D.customers(spark, sf).select("customer_id", "name", "tier")
    return m.join(c, on="customer_id", how="left")


@register("a11_j04_customer_metrics", with_("orders_raw", "customers", extra=_METRICS_SQL) +
          "SELECT * FROM customer_metrics")
def a11(spark, sf):
    return customer_metrics(spark, sf).orderBy(F.col("total_spent").desc())


@register("s07_overwrite_table", with_("orders_raw", "customers", extra=_METRICS_SQL) +
          "SELECT * FROM customer_metrics")
def s07(spark, sf):
    path = scratch_path(spark, "customer_metrics")
    customer_metrics(spark, sf).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --------------------------------------------------------- UDF and segments --

_SEG_SQL = """CASE WHEN unit_price IS NULL THEN 'UNKNOWN' WHEN unit_price >= 200 THEN 'WHALE'
                   WHEN unit_price >= 100 THEN 'HIGH' WHEN unit_price >= 25 THEN 'MEDIUM' ELSE 'LOW' END"""


@register("x01_classify_order_value", with_("orders_raw") + f"""
SELECT order_id, line_no, customer_id, unit_price, {_SEG_SQL} AS order_segment FROM orders_raw""")
def x01(spark, sf):
    return D.orders_raw(spark, sf).select("order_id", "line_no", "customer_id", "unit_price",
                                          S.classify_order_value("unit_price").alias("order_segment"))


@register("x02_x03_x05_udf_by_name", with_("orders_raw") + f"""
SELECT order_id, line_no, {_SEG_SQL} AS order_segment FROM orders_raw""")
def x02(spark, sf):
    register_classify_udf(spark)
    o = D.orders_raw(spark, sf)
    return o.select("order_id", "line_no",
                    F.call_udf("classify_order_value", F.col("unit_price").cast("double")).alias("order_segment"))


@register("x04_segment_breakdown", with_("orders_raw") + f"""
SELECT {_SEG_SQL} AS order_segment, COUNT(order_id) AS order_count,
       CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price
FROM orders_raw GROUP BY 1 ORDER BY avg_price DESC""")
def x04(spark, sf):
    o = D.orders_raw(spark, sf).withColumn("order_segment", S.classify_order_value("unit_price"))
    return (o.groupBy("order_segment").agg(
        F.count("order_id").alias("order_count"),
        (F.sum("unit_price").cast("double") / F.count("unit_price")).alias("avg_price"))
        .orderBy(F.desc("avg_price")))


# ------------------------------------------------------------- quality --

_NULLY_ORDERS_SQL = {"nully_orders": """
SELECT CASE WHEN order_id % 13 = 0 THEN NULL ELSE order_id END AS order_id, line_no, customer_id
FROM orders_raw"""}


def _nully_orders(spark, sf):
    o = D.orders_raw(spark, sf)
    return o.select(F.when(F.col("order_id") % 13 == 0, None).otherwise(F.col("order_id")).alias("order_id"),
                    "line_no", "customer_id")


@register("d01_not_null", with_("orders_raw", extra=_NULLY_ORDERS_SQL) +
          "SELECT * FROM nully_orders WHERE order_id IS NULL")
def d01(spark, sf):
    return Q.not_null_failures(_nully_orders(spark, sf), "order_id")


@register("d02_unique", with_("orders_raw") + """
SELECT order_id, COUNT(*) AS n FROM orders_raw WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) > 1""")
def d02(spark, sf):
    return Q.unique_failures(D.orders_raw(spark, sf), "order_id")


@register("d04_check_suite", with_("orders_raw", "changelog", extra=_NULLY_ORDERS_SQL) + """
SELECT 'not_null' AS check_name, 'orders_raw' AS table_name, 'order_id' AS column_name,
       COUNT(*) FILTER (WHERE order_id IS NULL) AS failures FROM nully_orders
UNION ALL
SELECT 'not_null', 'customers', 'customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM changelog
UNION ALL
SELECT 'unique', 'customers', 'customer_id', COUNT(*) FROM (
  SELECT customer_id FROM changelog WHERE customer_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
""")
def d04(spark, sf):
    res = Q.run_checks(
        {"orders_raw": _nully_orders(spark, sf), "customers": D.changelog(spark, sf)},
        [("not_null", "orders_raw", "order_id"), ("not_null", "customers", "customer_id"),
         ("unique", "customers", "customer_id")])
    return res.drop("status")
