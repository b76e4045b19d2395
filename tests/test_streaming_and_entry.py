"""Streaming refresh (incremental = batch, replay idempotence, dimension
changes) and the driver contract."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from conftest import SF001, rows
from strata.plans import medallion as M
from strata.sources import derived as D
from strata.streaming.dynamic import DynamicTables


def _gold_batch(spark, raw, dim):
    return rows(M.gold(M.silver(M.bronze(raw), dim)))


def test_stream_slices_equal_batch_and_replay_is_noop(spark, tmp):
    raw = D.orders_raw(spark, SF001)
    dim = D.customers(spark, SF001)
    dt = DynamicTables(spark, os.path.join(tmp, "dyn"), dim, raw.schema, buckets=4)
    part = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(3))
    src, ckpt = os.path.join(tmp, "src"), os.path.join(tmp, "ckpt")
    for i in (2, 0, 1):  # out of event order
        raw.filter(part == i).write.mode("append").parquet(src)
        dt.run(src, ckpt, available_now=True, max_files_per_trigger=1000)
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, dim)
    assert rows(dt.bronze.read().select(*M.BRONZE_COLS)) == rows(M.bronze(raw))
    before = rows(dt.gold_table())
    dt.refresh(raw.filter(part == 0), 0)  # batch 0 replayed: recorded, skipped
    assert rows(dt.gold_table()) == before


def test_dimension_change_refreshes_gold(spark, tmp):
    raw = D.orders_raw(spark, SF001)
    dim = D.customers(spark, SF001)
    # also exercises period partitions (order year x bucket) for bronze and silver
    dt = DynamicTables(spark, os.path.join(tmp, "dyn2"), dim, raw.schema, buckets=4, period_grain="year")
    half = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(2))
    dt.refresh(raw.filter(half == 0), 0)
    dt.refresh(raw.filter(half == 1), 1)
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, dim)
    new_dim = dim.withColumn("is_active", F.col("is_active") & (F.col("customer_id") % 3 != 0)) \
                 .withColumn("tier", F.when(F.col("customer_id") % 4 == 0, "gold").otherwise(F.col("tier")))
    dt.on_dimension_change(new_dim, "a")
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, new_dim)
    assert rows(dt.silver.read()) == rows(M.silver(M.bronze(raw), new_dim))


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


def test_processing_time_trigger_refreshes(spark, tmp):
    """The production trigger (a freshness target) keeps refreshing as files land."""
    raw = D.orders_raw(spark, SF001)
    dim = D.customers(spark, SF001)
    dt = DynamicTables(spark, os.path.join(tmp, "dyn3"), dim, raw.schema, buckets=4)
    src, ckpt = os.path.join(tmp, "src3"), os.path.join(tmp, "ckpt3")
    half = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(2))
    raw.filter(half == 0).write.parquet(src)
    q = dt.run(src, ckpt, available_now=False, freshness="1 second", max_files_per_trigger=1000)
    try:
        q.processAllAvailable()
        raw.filter(half == 1).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, dim)


@pytest.mark.parametrize("table", ["bronze", "silver", "dates", "gold"])
def test_refresh_replayed_after_a_crash_is_exactly_once(spark, tmp, monkeypatch, table):
    """A crash between a table's commit and its marker, then the same batch again."""
    raw, dim = D.orders_raw(spark, SF001), D.customers(spark, SF001)
    dt = DynamicTables(spark, os.path.join(tmp, "crash"), dim, raw.schema, buckets=2)
    half = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(2))
    dt.refresh(raw.filter(half == 0), 0)
    target = getattr(dt, table)
    with monkeypatch.context() as m:
        def crash(batch_id):
            raise RuntimeError("crash before the marker")

        m.setattr(target, "_mark", crash)
        with pytest.raises(RuntimeError, match="crash before the marker"):
            dt.refresh(raw.filter(half == 1), 1)
    dt.refresh(raw.filter(half == 1), 1)
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, dim)  # last_order_date included
    assert rows(dt.silver.read()) == rows(M.silver(M.bronze(raw), dim))
    assert dt.dates.read().agg(F.sum("n")).first()[0] == dt.gold_table().agg(F.sum("total_orders")).first()[0]


def test_failed_dimension_change_is_not_lost(spark, tmp, monkeypatch):
    raw, dim = D.orders_raw(spark, SF001), D.customers(spark, SF001)
    dt = DynamicTables(spark, os.path.join(tmp, "dimcrash"), dim, raw.schema, buckets=2)
    dt.refresh(raw, 0)
    new_dim = dim.withColumn("tier", F.lit("gold"))

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(dt, "apply_gold_delta", crash)
        with pytest.raises(RuntimeError, match="crash"):
            dt.on_dimension_change(new_dim, "a")
    dt.on_dimension_change(new_dim, "a")
    assert rows(dt.gold_table()) == _gold_batch(spark, raw, new_dim)
