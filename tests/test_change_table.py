"""Tables that append their changes, and the streams on them: batches write in proportion to themselves."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.plans import medallion as M
from strata.plans.catalog_stream import write_slices
from strata.sources import change_table, files
from strata.sources.change_table import CHANGE, ChangeTable
from strata.streaming.dynamic import DynamicTables
from strata.streaming.layers import LayeredTables

RAW = ("order_id long, customer_id long, product_id long, quantity int, unit_price decimal(12,2), order_date date, status string, "
       "loaded_at timestamp_ntz, line_no int, supp_id long")
CUSTOMERS = "customer_id long, name string, tier string, is_active boolean"


def order(k, day, status="PAID", customer=None):
    return (k, k % 4 if customer is None else customer, 1, 2, Decimal(k), dt.date(2024, 1, 1 + k % 9), status, dt.datetime(2024, 2, day), 1, 1)


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([(0, "a", "gold", True), (1, "b", None, True), (2, None, "gold", True), (3, "d", "gold", False)], CUSTOMERS)


BATCHES = [[order(k, 1 + k % 3) for k in range(40)],
           [order(k, 2, "CANCELLED") for k in range(0, 40, 2)] + [order(50, 1, None), (None, *order(7, 1)[1:])],
           [order(k, 3, customer=1) for k in range(0, 40, 5)] + [order(k, 1) for k in range(40)]]


@pytest.mark.parametrize("most", [1, 50])
def test_batches_on_every_bucket_add_files_and_equal_the_whole(spark, tmp, dim, monkeypatch, most):
    """A batch rewrites nothing, though it meets all buckets; changes written together give the same rows."""
    monkeypatch.setattr(change_table, "MOST_CHANGES", most)
    raw = [spark.createDataFrame(b, RAW) for b in BATCHES]
    tables = DynamicTables(spark, os.path.join(tmp, "t"), dim, raw[0].schema, buckets=2)
    kept = {}
    for i, batch in enumerate(raw):
        tables.refresh(batch, i)
        for t in (tables.bronze, tables.silver, tables.dates, tables.gold):
            there = {os.path.join(d, f) for d, _, names in os.walk(t.path) for f in names if f.endswith(".parquet")}
            assert most < 50 or kept.get(t.path, set()) < there
            kept[t.path] = there
    later = dim.withColumn("tier", F.when(F.col("customer_id") == 0, "new").otherwise(F.col("tier")))
    tables.on_dimension_change(later, "a")
    assert most > 1 or tables.gold._base() > 0
    whole = M.bronze(raw[0].unionByName(raw[1]).unionByName(raw[2]))
    assert rows(tables.bronze.read().select(*M.BRONZE_COLS)) == rows(whole)
    silver = M.silver(whole.filter("order_id is not null"), later)
    assert rows(tables.silver.read()) == rows(silver) and rows(tables.gold_table()) == rows(M.gold(silver))


def test_a_customer_that_is_there_twice_gives_two_silver_rows(spark, tmp, dim):
    twice = dim.unionByName(dim.filter("customer_id = 1"))
    raw = [spark.createDataFrame(b, RAW) for b in BATCHES[:2]]
    tables = DynamicTables(spark, os.path.join(tmp, "t"), twice, raw[0].schema, buckets=2)
    for i, batch in enumerate(raw):
        tables.refresh(batch, i)
    silver = M.silver(M.bronze(raw[0].unionByName(raw[1])).filter("order_id is not null"), twice)
    assert rows(tables.silver.read()) == rows(silver)
    assert rows(tables.gold_table(), "customer_name", "lifetime_value", "last_order_date") == rows(M.gold(silver), "customer_name", "lifetime_value", "last_order_date")


def test_an_older_row_changes_nothing(spark, tmp, dim):
    raw = [spark.createDataFrame(b, RAW) for b in ([order(1, 5)], [order(1, 4, "CANCELLED")])]
    tables = DynamicTables(spark, os.path.join(tmp, "t"), dim, raw[0].schema, buckets=2)
    for i, batch in enumerate(raw):
        tables.refresh(batch, i)
    assert tables.silver.changes().count() == tables.gold.changes().count() == 1


def test_rows_of_an_attempt_that_broke_off_are_not_read(spark, tmp, monkeypatch):
    df = spark.range(8).withColumn("v", F.lit(1))
    t = ChangeTable(spark, os.path.join(tmp, "it's"), ["id"], 3, df.schema, lambda c: c.groupBy("id").agg(F.sum("v").cast("int").alias("v")))
    t.append(t.dealt(df), "a")
    with monkeypatch.context() as m:
        m.setattr(t, "_mark", lambda batch_id: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            t.append(t.dealt(df), "b")
    assert t.read().agg(F.sum("v")).first()[0] == 8
    again = ChangeTable(spark, t.path, ["id"], 16, df.schema, t.merged)  # keeps its buckets
    again.append(again.dealt(df), "b")
    again.append(again.dealt(df), "b")
    assert again.read().agg(F.sum("v")).first()[0] == 16 and again.change("b").select(CHANGE).distinct().count() == 1
    assert "Exchange hashpartitioning" not in again.read()._jdf.queryExecution().executedPlan().toString()


def test_a_batch_of_a_layer_reads_its_files_itself(spark, tmp, dim):
    """The stream hands on no rows, so uses of a batch do not read it whole again."""
    customers = dim.withColumn("seq", F.lit(0))
    raw = spark.createDataFrame(BATCHES[0], RAW)
    layers = LayeredTables(spark, os.path.join(tmp, "l s"), raw.schema, customers.schema, buckets=2)
    assert layers._stream(("orders", "customers")).columns == ["name", "file", "landed"]
    layers.land("orders", raw, "first load")
    layers.land("customers", customers, "all")
    layers.refresh("gold")
    assert rows(layers.read("gold")) == rows(M.gold(M.silver(M.bronze(raw), dim)))
    done = {r.layer: r for r in layers.refreshes().collect()}
    assert done["bronze"].rows == 40 and done["silver"].rows == 44 and done["bronze"].lag_seconds >= 0


def test_slices_are_written_by_many_tasks(spark, tmp):
    df = spark.range(0, 1000, 1, 4).withColumnRenamed("id", "k")
    back = write_slices(df, F.col("k") % 2, os.path.join(tmp, "s"))
    assert rows(back) == rows(df)
    assert all(sum(n.endswith(".parquet") for n in files.names(spark, os.path.join(tmp, f"s/slice={i}"))) == 4 for i in (0, 1))
