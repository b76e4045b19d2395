"""Semi-structured documents on Spark's VARIANT type.

``object_construct`` drops NULL-valued keys (at every level) by going
through JSON text once; ``path`` extraction and ``flatten`` work on the
stored VARIANT column, which parquet keeps as-is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def object_construct(**fields: Column) -> Column:
    """``OBJECT_CONSTRUCT('k', v, ...)`` as VARIANT; NULL values drop their key."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()])))


def object_struct(**fields: Column) -> Column:
    """A nested object inside ``object_construct`` (kept as a struct until the outer call)."""
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def array_construct(*items: Column) -> Column:
    """``ARRAY_CONSTRUCT(...)``."""
    return F.array(*items)


def path(v: str | Column, json_path: str, dtype: str) -> Column:
    """``v:a:b[0]:c::T`` (V05/V06); a missing key or index gives NULL."""
    col = F.col(v) if isinstance(v, str) else v
    return F.try_variant_get(col, json_path, dtype)


def flatten(df: DataFrame, v: str, json_path: str, outer: bool = False, alias: str = "item") -> DataFrame:
    """``LATERAL FLATTEN(INPUT => v:path)`` (V07/J08): one row per element with
    ``<alias>_index`` and ``<alias>`` (the element as VARIANT).

    Inner form drops rows whose input is missing or empty; ``outer`` keeps
    them with NULLs, like FLATTEN(..., OUTER => TRUE).
    """
    arr = F.try_variant_get(F.col(v), json_path, "array<variant>")
    gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
    return df.select("*", gen.alias(f"{alias}_index", alias))


def parse(text: str | Column, strict: bool = False) -> Column:
    """``PARSE_JSON`` (V04); non-strict gives NULL for malformed text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.parse_json(col) if strict else F.try_parse_json(col)


def order_documents(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The document lab's table: one order document per **line item**.

    Three-way inner join (J01), then one VARIANT per joined row; the
    customer dimension is left to AQE's size-checked broadcast.
    """
    # orders and line items are both fact tables: join them by shuffle (the plan
    # they get at any real scale) rather than broadcasting whichever looks small
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice",
                      "o_orderpriority").hint("merge")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linenumber")
    j = o.join(c, o.o_custkey == c.c_custkey).join(li, o.o_orderkey == li.l_orderkey)
    doc = object_construct(
        order_id=F.col("o_orderkey"),
        customer_id=F.col("o_custkey"),
        status=F.col("o_orderstatus"),
        order_date=F.col("o_orderdate").cast("date"),
        total_price=F.col("o_totalprice"),
        priority=F.col("o_orderpriority"),
        customer=object_struct(name=F.col("c_name"), nation=F.col("c_nationkey"), segment=F.col("c_mktsegment")),
        items=array_construct(object_struct(part=F.col("l_partkey"), qty=F.col("l_quantity"),
                                            price=F.col("l_extendedprice"))),
    )
    return j.select(doc.alias("raw_data"))
