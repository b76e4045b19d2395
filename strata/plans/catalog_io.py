"""Sources, sinks and documents: CSV load with rejects and load history, landing
listing, seeds, inserts with defaults, temp views, VARIANT documents
(S01-S04, S06, S08-S11, S15, V01-V08, J08)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import documents as V
from strata.operators.relational import add_column_if_absent, append_with_defaults, update_where
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path
from strata.sources import csv_load as C
from strata.sources import derived as D
from strata.sources.tables import table

AS_OF = "2024-01-31 00:00:00"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
HEADER = "event_id,ts,user_id,event_type,value,props"


def write_events_landing(spark, sf, path: str) -> str:
    """Write ``events`` as CSV files, one per day, with the defects a landing
    zone has: a header per file, padded fields, the null tokens NULL / null /
    empty, a bad number (``value`` = x), a missing and an extra field.

    Lines are built with column expressions and written as text, so the
    defects are exact; every row of ``events`` is written.
    """
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    props = (F.when(eid % 13 == 0, "NULL").when(eid % 17 == 0, "null").when(eid % 19 == 0, "")
             .otherwise(F.concat(F.lit('"'), F.replace(F.col("props"), F.lit('"'), F.lit('""')), F.lit('"'))))
    value = F.when(eid % 97 == 0, "x").otherwise(F.col("value").cast("string"))
    fields = [eid.cast("string"), F.col("ts").cast("string"), F.col("user_id").cast("string"),
              F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")), value, props]
    line = (F.when(eid % 89 == 0, F.concat_ws(",", *fields[:-1]))
            .when(eid % 83 == 0, F.concat(F.concat_ws(",", *fields), F.lit(",extra")))
            .otherwise(F.concat_ws(",", *fields)))
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = e.select(day.alias("load_day"), F.lit(1).alias("_h"), eid.alias("_k"), line.alias("value"))
    headers = rows.select("load_day").distinct().select(
        "load_day", F.lit(0).alias("_h"), F.lit(-1).cast("long").alias("_k"), F.lit(HEADER).alias("value"))
    (rows.unionByName(headers).repartition("load_day").sortWithinPartitions("load_day", "_h", "_k")
     .select("value", "load_day").write.mode("overwrite").partitionBy("load_day").text(path))
    return path


_BAD_SQL = "(event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0)"
_ERR_SQL = """CASE WHEN event_id % 89 = 0 OR event_id % 83 = 0 THEN 'number of columns does not match'
                   WHEN event_id % 97 = 0 THEN 'cannot convert column value to double' END"""


def _landing(spark, sf):
    return write_events_landing(spark, sf, scratch_path(spark, "landing"))


@register("s01_s02_csv_load_good_rows", f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE props END AS props
FROM events WHERE NOT {_BAD_SQL}""")
def s02_good(spark, sf):
    good, _ = C.copy_into(spark, _landing(spark, sf), EVENTS_SCHEMA)
    return good


@register("s02_csv_load_rejects", f"""
SELECT strftime(ts, '%Y-%m-%d') AS load_day, {_ERR_SQL} AS error FROM events WHERE {_BAD_SQL}""")
def s02_rejects(spark, sf):
    _, rej = C.copy_into(spark, _landing(spark, sf), EVENTS_SCHEMA)
    return rej.select(F.regexp_extract("file", r"load_day=([0-9-]+)", 1).alias("load_day"), "error")


@register("s03_load_history_latest", f"""
SELECT 'EVENTS' AS table_name, strftime(ts, '%Y-%m-%d') AS load_day, COUNT(*) AS rows_parsed,
       COUNT(*) FILTER (WHERE NOT {_BAD_SQL}) AS rows_loaded,
       COUNT(*) FILTER (WHERE {_BAD_SQL}) AS errors_seen,
       MIN({_ERR_SQL}) AS first_error,
       CASE WHEN COUNT(*) FILTER (WHERE {_BAD_SQL}) = 0 THEN 'LOADED'
            WHEN COUNT(*) FILTER (WHERE NOT {_BAD_SQL}) = 0 THEN 'LOAD_FAILED'
            ELSE 'PARTIALLY_LOADED' END AS status,
       TIMESTAMP '{AS_OF}' AS last_load_time
FROM events GROUP BY 2 ORDER BY load_day DESC LIMIT 10""")
def s03(spark, sf):
    h = C.load_history(spark, _landing(spark, sf), EVENTS_SCHEMA, "events",
                       load_time=F.lit(AS_OF).cast("timestamp_ntz"))
    top = C.latest_loads(h, "events", 10)
    return top.select("table_name", F.regexp_extract("file_name", r"load_day=([0-9-]+)", 1).alias("load_day"),
                      "rows_parsed", "rows_loaded", "errors_seen", "first_error", "status", "last_load_time")


@register("s02_s03_copy_into_replay_once", f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE props END AS props
FROM events WHERE NOT {_BAD_SQL}""")
def s02_replay(spark, sf):
    """The same landing zone loaded twice: the second run finds every file in
    the load history and adds nothing."""
    landing = _landing(spark, sf)
    table, hist = scratch_path(spark, "events_tbl"), scratch_path(spark, "events_load_history")
    for _ in range(2):
        C.copy_into_table(spark, landing, EVENTS_SCHEMA, table, hist, "events")
    return spark.read.parquet(table).drop("load_id")


@register("s04_list_landing_zone")
def s04(spark, sf):
    return C.list_files(spark, _landing(spark, sf), "*.txt")


# Seeds: a products CSV derived from ``part`` with quoted commas and trailing spaces.
SEED_SCHEMA = T.StructType([
    T.StructField("sku", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()), T.StructField("price", T.IntegerType()),
    T.StructField("description", T.StringType()),
])


@register("s06_seed_load", """
SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name || '  ' AS name, p_type AS type,
       CAST(round(p_retailprice * 100) AS INTEGER) AS price,
       p_name || ', size ' || CAST(p_size AS VARCHAR) || ', ' || p_brand AS description
FROM part""")
def s06(spark, sf):
    p = table(spark, sf, "part")
    seed = p.select(
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.concat("p_name", F.lit("  ")).alias("name"), F.col("p_type").alias("type"),
        F.round(F.col("p_retailprice") * 100).cast("int").alias("price"),
        F.concat_ws("", "p_name", F.lit(", size "), F.col("p_size").cast("string"), F.lit(", "), "p_brand")
        .alias("description"))
    path = scratch_path(spark, "seed_products")
    (seed.write.mode("overwrite").option("header", "true").option("quote", '"').option("escape", '"')
     .option("ignoreTrailingWhiteSpace", "false").option("ignoreLeadingWhiteSpace", "false").csv(path))
    return C.read_seed(spark, path, SEED_SCHEMA)


# INSERT with a column list (others take defaults) and INSERT with all columns.
CUSTOMERS_TABLE = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()), T.StructField("tier", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


@register("s08_s10_insert_with_defaults", with_("customers") + f"""
SELECT customer_id, name, email, 'standard' AS tier, TIMESTAMP '{AS_OF}' AS updated_at
FROM customers WHERE customer_id % 2 = 0
UNION ALL
SELECT customer_id, name, email, tier, TIMESTAMP '2024-01-15 00:00:00' FROM customers WHERE customer_id % 2 = 1""")
def s08(spark, sf):
    c = D.customers(spark, sf)
    path = scratch_path(spark, "raw_customers")
    spark.createDataFrame([], CUSTOMERS_TABLE).write.mode("overwrite").parquet(path)  # CREATE TABLE
    defaults = {"tier": F.lit("standard"), "updated_at": F.lit(AS_OF).cast("timestamp_ntz")}
    named = c.filter(F.col("customer_id") % 2 == 0).select("customer_id", "name", "email")
    append_with_defaults(CUSTOMERS_TABLE, named, defaults).write.mode("append").parquet(path)
    full = c.filter(F.col("customer_id") % 2 == 1).select(
        "customer_id", "name", "email", "tier", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    append_with_defaults(CUSTOMERS_TABLE, full, defaults).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("s11_g05_add_column_then_update", with_("customers") + """
SELECT customer_id, name, tier, lower(name) || '@example.com' AS email_address,
       CASE WHEN customer_id % 3 = 0 THEN 'US' WHEN customer_id % 3 = 1 THEN 'EU' ELSE 'US' END AS region
FROM customers""")
def s11(spark, sf):
    c = D.customers(spark, sf).select("customer_id", "name", "tier")
    c = add_column_if_absent(c, "email_address", "string")
    c = add_column_if_absent(c, "email_address", "string")  # second call is a no-op
    c = update_where(c, F.col("email_address").isNull(),
                     email_address=F.concat(F.lower("name"), F.lit("@example.com")))
    c = add_column_if_absent(c, "region", "string")
    k = F.col("customer_id") % 3
    return update_where(c, F.lit(True), region=F.when(k == 0, "US").when(k == 1, "EU").otherwise("US"))


@register("s15_temp_view_sql", with_("orders_raw") + """
SELECT status, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS qty FROM orders_raw GROUP BY status""")
def s15(spark, sf):
    D.orders_raw(spark, sf).createOrReplaceTempView("orders_raw_session")
    return spark.sql("SELECT status, COUNT(*) AS n, CAST(SUM(quantity) AS BIGINT) AS qty "
                     "FROM orders_raw_session GROUP BY status")


# ------------------------------------------------------------- documents --

def _documents(spark, sf):
    """CTAS of the document table (S09/V03), stored as a VARIANT parquet column."""
    docs = V.order_documents(table(spark, sf, "orders"), table(spark, sf, "customer"), table(spark, sf, "lineitem"))
    path = scratch_path(spark, "order_documents")
    docs.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_DOC_FIELDS_SQL = """
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS status,
       o.o_totalprice AS total_price, c.c_name AS customer_name, c.c_mktsegment AS segment,
       l.l_quantity AS first_item_qty, l.l_extendedprice AS first_item_price,
       CAST(NULL AS DOUBLE) AS second_item_qty
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""


@register("v01_v03_v05_v06_document_paths", _DOC_FIELDS_SQL)
def v05(spark, sf):
    d = _documents(spark, sf)
    return d.select(
        V.path("raw_data", "$.order_id", "bigint").alias("order_id"),
        V.path("raw_data", "$.order_date", "date").alias("order_date"),
        V.path("raw_data", "$.status", "string").alias("status"),
        V.path("raw_data", "$.total_price", "double").alias("total_price"),
        V.path("raw_data", "$.customer.name", "string").alias("customer_name"),
        V.path("raw_data", "$.customer.segment", "string").alias("segment"),
        V.path("raw_data", "$.items[0].qty", "double").alias("first_item_qty"),
        V.path("raw_data", "$.items[0].price", "double").alias("first_item_price"),
        V.path("raw_data", "$.items[1].qty", "double").alias("second_item_qty"),
    )


@register("v07_j08_flatten_items", """
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date, 0 AS item_index,
       CAST(l.l_partkey AS INTEGER) AS part_key, l.l_quantity AS quantity, l.l_extendedprice AS price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def v07(spark, sf):
    d = V.flatten(_documents(spark, sf), "raw_data", "$.items")
    return d.select(
        V.path("raw_data", "$.order_id", "bigint").alias("order_id"),
        V.path("raw_data", "$.order_date", "date").alias("order_date"),
        F.col("item_index"),
        V.path("item", "$.part", "int").alias("part_key"),
        V.path("item", "$.qty", "double").alias("quantity"),
        V.path("item", "$.price", "double").alias("price"),
    )


@register("v04_parse_json_text", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       json_extract(props, '$.missing') IS NULL AS missing_is_null
FROM events""")
def v04(spark, sf):
    e = table(spark, sf, "events").select("event_id", V.parse("props").alias("p"))
    return e.select("event_id", V.path("p", "$.k", "int").alias("k"),
                    V.path("p", "$.missing", "string").isNull().alias("missing_is_null"))
