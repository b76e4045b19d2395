"""Governance queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import governance as G
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path
from strata.sources import derived as D
from strata.sources.tables import table

AS_OF = "2024-01-31 00:00:00"
ROLES = ("ACCOUNTADMIN", "DATA_ENGINEER_FR", "ANALYST_FR", "PUBLIC")
# The lab maps the analyst to one region and the engineer to all (NULL);
# region names here are the driver's region table's.
ACCESS_MAP = [("ANALYST_FR", "AMERICA"), ("DATA_ENGINEER_FR", None)]
BUDGET_QUOTA = 150.0


def access_map(spark):
    """The policy's mapping table; a literal list, so its size is known here."""
    return F.broadcast(spark.createDataFrame(ACCESS_MAP, "role_name string, region string"))


def _role_sql(role: str, expr_full: str, expr_analyst: str, expr_other: str) -> str:
    if role in G.FULL_ACCESS_ROLES:
        return expr_full
    if role == G.ANALYST_ROLE:
        return expr_analyst
    return expr_other


def _masked_sql():
    parts = []
    for r in ROLES:
        em = _role_sql(r, "email", "regexp_replace(email, '.*@', '****@')", "'***REDACTED***'")
        tm = _role_sql(r, "tier", "'***'", "CAST(NULL AS VARCHAR)")
        parts.append(f"SELECT '{r}' AS role_name, customer_id, name, {em} AS email_address, {tm} AS tier "
                     f"FROM customers")
    return "\nUNION ALL\n".join(parts)


@register("g01_g02_g03_column_masks", with_("customers") + _masked_sql())
def g03(spark, sf):
    c = D.customers(spark, sf).select("customer_id", "name", F.col("email").alias("email_address"), "tier")
    policies = {"email_address": G.email_mask, "tier": G.tier_mask}
    views = [G.secured(c, r, policies).select(F.lit(r).alias("role_name"), "*") for r in ROLES]
    return reduce(DataFrame.unionByName, views)


def _row_access_sql():
    parts = []
    for r in ROLES:
        if r in G.ALL_ROWS_ROLES:
            cond = "TRUE"
        else:
            cond = ("EXISTS (SELECT 1 FROM (VALUES ('ANALYST_FR', 'AMERICA'), ('DATA_ENGINEER_FR', NULL)) "
                    f"m(role_name, region) WHERE m.role_name = '{r}' AND (m.region = o.region OR m.region IS NULL))")
        parts.append(f"SELECT '{r}' AS role_name, o.order_id, o.customer_id, o.region, o.status "
                     f"FROM orders_with_region o WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


_ORDERS_REGION_SQL = {"orders_with_region": """
SELECT b.order_id, b.customer_id, b.status, c.region FROM bronze b LEFT JOIN customers c USING (customer_id)"""}


def orders_with_region(spark, sf):
    from strata.plans.medallion import bronze

    b = bronze(D.orders_raw(spark, sf)).select("order_id", "customer_id", "status")
    return b.join(D.customers(spark, sf).select("customer_id", "region"), "customer_id", "left")


@register("g04_j06_row_access_policy", with_("bronze", "customers", extra=_ORDERS_REGION_SQL) + _row_access_sql())
def g04(spark, sf):
    # policies apply to the stored orders table (with its added region column): write it once,
    # then every role's view reads that table
    path = scratch_path(spark, "orders_with_region")
    orders_with_region(spark, sf).select("order_id", "customer_id", "region", "status").write.parquet(path)
    o = spark.read.parquet(path)
    policy = G.region_access(access_map(spark))
    views = [G.secured(o, r, row_policy=policy).select(F.lit(r).alias("role_name"), "*") for r in ROLES]
    return reduce(DataFrame.unionByName, views)


@register("g09_p07_access_audit", with_("query_log") + f"""
SELECT event_id, start_time, user_name, role_name, query_text FROM query_log
WHERE query_text ILIKE '%email_address%' AND start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
ORDER BY start_time DESC""")
def g09(spark, sf):
    return G.access_audit(D.query_log(spark, sf), "%email_address%", F.lit(AS_OF).cast("timestamp_ntz")).select(
        "event_id", "start_time", "user_name", "role_name", "query_text")


@register("g10_usage_by_warehouse", with_("metering") + f"""
SELECT warehouse_name, CAST(SUM(CAST(credits_used AS DECIMAL(18,4))) AS DOUBLE) AS total_credits,
       CAST(SUM(CAST(credits_used AS DECIMAL(18,4))) AS DOUBLE) AS compute_credits,
       COUNT(*) AS query_count
FROM metering WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
GROUP BY warehouse_name ORDER BY total_credits DESC""")
def g10(spark, sf):
    return G.usage_by_warehouse(D.metering(spark, sf), F.lit(AS_OF).cast("timestamp_ntz"))


def _budget_sql():
    parts = []
    for pct, action in ((80, "NOTIFY"), (100, "SUSPEND")):
        level = BUDGET_QUOTA * pct / 100.0
        parts.append(f"""
SELECT usage_day, {pct} AS trigger_percent, '{action}' AS action, start_time, event_id,
       CAST(running_total AS DOUBLE) AS running_credits
FROM run WHERE running_total >= CAST({level} AS DECIMAL(18,4))
QUALIFY row_number() OVER (PARTITION BY usage_day ORDER BY start_time, event_id) = 1""")
    return "\nUNION ALL\n".join(parts)


_RUN_SQL = {"run": """
SELECT CAST(start_time AS DATE) AS usage_day, start_time, event_id,
       SUM(CAST(credits_used AS DECIMAL(18,4))) OVER (PARTITION BY CAST(start_time AS DATE)
           ORDER BY start_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total
FROM metering"""}


@register("g11_budget_alerts", with_("metering", extra=_RUN_SQL) + _budget_sql())
def g11(spark, sf):
    return G.budget_alerts(D.metering(spark, sf), BUDGET_QUOTA)


_EDGES_SQL = {"edges": """
SELECT c.c_name AS child, n.n_name AS parent FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
UNION
SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""}


def role_edges(spark, sf):
    """A grant hierarchy from the data: customer roles roll up to their
    nation's role, nation roles to their region's."""
    c = table(spark, sf, "customer").select("c_name", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    e1 = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_name").alias("child"), F.col("n_name").alias("parent"))
    e2 = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    return e1.unionByName(e2)


_CLOSURE_SQL = "WITH RECURSIVE edges AS (" + _EDGES_SQL["edges"] + """),
cl(child, parent) AS (
  SELECT child, parent FROM edges
  UNION
  SELECT cl.child, e.parent FROM cl JOIN edges e ON cl.parent = e.child)"""


@register("g12_role_closure", _CLOSURE_SQL + " SELECT child, parent FROM cl")
def g12(spark, sf):
    return G.role_closure(role_edges(spark, sf))


GRANTED_AT = "1995-06-17"


def role_grants(spark, sf):
    """Each customer role may read its segment's schema: the tables there at
    the grant, or (odd keys) those created later."""
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("role"), F.lit("SELECT").alias("privilege"), F.col("c_mktsegment").alias("schema_name"),
        F.when(F.col("c_custkey") % 2 == 0, "ALL").otherwise("FUTURE").alias("scope"),
        F.lit(GRANTED_AT).cast("date").alias("granted_at"))


def segment_tables(spark, sf):
    """One table per segment, order priority and year, created with its first order."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    name = F.concat_ws("_", "o_orderpriority", F.year("day"))
    return (o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_mktsegment").alias("schema_name"), name.alias("table_name"))
            .agg(F.min("day").alias("created_at")))


@register("g13_effective_privileges", _CLOSURE_SQL + f""",
grants AS (SELECT c_name AS role, c_mktsegment AS schema_name, c_custkey % 2 = 0 AS existing FROM customer),
holders AS (SELECT parent AS role, child AS via FROM cl UNION SELECT role, role FROM grants),
tabs AS (SELECT c.c_mktsegment AS schema_name, concat_ws('_', o.o_orderpriority, year(o.o_orderdate)) AS table_name,
                min(CAST(o.o_orderdate AS DATE)) AS created_at
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT DISTINCT h.role, 'SELECT' AS privilege, t.schema_name, t.table_name
FROM holders h JOIN grants g ON h.via = g.role JOIN tabs t USING (schema_name)
WHERE CASE WHEN g.existing THEN t.created_at <= DATE '{GRANTED_AT}' ELSE t.created_at > DATE '{GRANTED_AT}' END""")
def g13(spark, sf):
    return G.effective_privileges(G.role_closure(role_edges(spark, sf)), role_grants(spark, sf), segment_tables(spark, sf))
