"""ANSI-SQL (DuckDB) twins of ``strata.sources.derived`` for the oracle.

``with_(...)`` builds a WITH clause from the named derivations so each
oracle query reads the same pre-registered driver tables.
"""

from __future__ import annotations

DERIVED = {
    "orders_raw": """
SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
       CAST(l.l_quantity AS INTEGER) AS quantity,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS unit_price,
       CAST(o.o_orderdate AS DATE) AS order_date,
       CASE WHEN o.o_orderkey % 10 = 0 THEN 'CANCELLED' WHEN o.o_orderstatus = 'O' THEN 'PAID'
            WHEN o.o_orderstatus = 'F' THEN 'SHIPPED' ELSE 'PENDING' END AS status,
       l.l_shipdate AS loaded_at, l.l_linenumber AS line_no, l.l_suppkey AS supp_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "customers": """
SELECT c.c_custkey AS customer_id, c.c_name AS name, lower(c.c_name) || '@example.com' AS email,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'gold' WHEN 'FURNITURE' THEN 'platinum'
            ELSE 'standard' END AS tier,
       c.c_custkey % 10 <> 0 AS is_active, r.r_name AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "changelog": """
SELECT event_id AS seq, user_id AS customer_id, ts AS updated_at,
       CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS action, props
FROM events""",
    "query_log": """
SELECT event_id, ts AS start_time, user_id AS user_name, event_type AS role_name,
       CASE WHEN event_id % 7 = 0 THEN 'select EMAIL_ADDRESS from customers'
            ELSE 'select tier from customers' END AS query_text
FROM events""",
    "metering": """
SELECT event_id, ts AS start_time, 'wh_' || CAST(user_id % 5 AS VARCHAR) AS warehouse_name,
       value / 100 AS credits_used
FROM events""",
    "feedback": "SELECT doc_id AS feedback_id, text AS feedback_text FROM documents",
    "policies": "SELECT doc_id, source AS policy_name, text AS content FROM documents",
    "questions": "SELECT item_id AS q_id, text AS question FROM benchmark",
    "bronze": """
SELECT order_id, customer_id, product_id, quantity, unit_price, order_date, status, loaded_at
FROM orders_raw
QUALIFY row_number() OVER (PARTITION BY order_id
                           ORDER BY loaded_at DESC NULLS FIRST, line_no DESC NULLS FIRST,
                                    product_id DESC NULLS FIRST, supp_id DESC NULLS FIRST) = 1""",
    "silver": """
SELECT o.order_id, o.order_date, o.status, o.quantity, o.unit_price,
       CAST(o.quantity * o.unit_price AS DECIMAL(23,2)) AS line_total,
       c.name AS customer_name, c.tier AS customer_tier, o.customer_id
FROM bronze o LEFT JOIN customers c ON o.customer_id = c.customer_id AND c.is_active = TRUE""",
    "gold": """
SELECT customer_name, customer_tier,
       COUNT(DISTINCT order_id) AS total_orders,
       CAST(SUM(line_total) AS DOUBLE) AS lifetime_value,
       CAST(SUM(line_total) AS DOUBLE) / COUNT(line_total) AS avg_order_value,
       MAX(order_date) AS last_order_date
FROM silver WHERE status <> 'CANCELLED'
GROUP BY customer_name, customer_tier""",
}

# Dependencies between derivations (emitted in this order).
_DEPS = {
    "bronze": ["orders_raw"],
    "silver": ["bronze", "customers"],
    "gold": ["silver"],
}


def _expand(names):
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` for derived names plus extra CTEs."""
    parts = [f"{n} AS ({DERIVED[n]})" for n in _expand(names)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n"
