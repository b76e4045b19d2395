"""Reference-shaped tables derived from the driver's parquet tables.

Each function is a pure DataFrame expression over the given tables, so its
work grows with them. The same derivations exist as SQL in
``strata.plans.sqlbase`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table

# Total order for "latest line of an order" (the reference leaves ties open).
ORDERS_LATEST = ("loaded_at", "line_no", "product_id", "supp_id")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines shaped like the lab's ``raw.orders_raw`` (order_id repeats)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    # fact-to-fact join: shuffle both sides (never broadcast a fact table)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").hint("merge")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    status = (F.when(F.col("o_orderkey") % 10 == 0, "CANCELLED")
              .when(F.col("o_orderstatus") == "O", "PAID")
              .when(F.col("o_orderstatus") == "F", "SHIPPED")
              .otherwise("PENDING"))
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"),
        F.col("l_shipdate").alias("loaded_at"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supp_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension with email, tier, is_active and region."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "gold")
        .when(F.col("c_mktsegment") == "FURNITURE", "platinum")
        .otherwise("standard").alias("tier"),
        (F.col("c_custkey") % 10 != 0).alias("is_active"),
        F.col("r_name").alias("region"),
    )


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer change log: one action per event, ordered by (updated_at, seq)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("updated_at"),
        F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT").alias("action"),
        "props",
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("start_time"),
        F.col("user_id").alias("user_name"),
        F.col("event_type").alias("role_name"),
        F.when(F.col("event_id") % 7 == 0, "select EMAIL_ADDRESS from customers")
        .otherwise("select tier from customers").alias("query_text"),
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("start_time"),
        F.concat(F.lit("wh_"), (F.col("user_id") % 5).cast("string")).alias("warehouse_name"),
        (F.col("value") / 100).alias("credits_used"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("feedback_id"), F.col("text").alias("feedback_text"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("policy_name"), F.col("text").alias("content"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("q_id"), F.col("text").alias("question"))


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that carry an embedding (doc_id = vec_id)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return d.join(e, d.doc_id == e.vec_id).select("doc_id", "source", "embedding")


def question_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark question's vector is the embedding with vec_id = item_id."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    q = questions(spark, sf_dir)
    return q.join(e, q.q_id == e.vec_id).select("q_id", "embedding")
