"""Layers as streams of their own: any order of changes, restarts, crashes,
freshness targets, refresh on demand; and the stateful latest-row stream."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata.plans import medallion as M
from strata.sources import derived as D
from strata.sources.store import BucketedTable
from strata.streaming.layers import LayeredTables
from strata.streaming.stateful import drain_latest, latest_rows


@pytest.fixture()
def data(spark, tmp):
    raw = D.orders_raw(spark, SF001)
    first = D.customers(spark, SF001).withColumn("seq", F.lit(0))
    later = (first.filter("customer_id % 3 = 0").withColumn("seq", F.lit(1))
             .withColumn("tier", F.lit("gold")).withColumn("is_active", F.col("customer_id") % 2 == 0))
    dim = first.join(later.select("customer_id"), "customer_id", "left_anti").unionByName(later)
    part = F.pmod(F.xxhash64("order_id", "line_no"), F.lit(2))

    def new(name, **kw):
        return LayeredTables(spark, os.path.join(tmp, name), raw.schema, first.schema, buckets=2, **kw)

    return {"raw": raw, "halves": [raw.filter(part == i) for i in (0, 1)], "first": first, "later": later, "dim": dim, "new": new}


def check(layers, raw, dim):
    assert rows(layers.read("bronze")) == rows(M.bronze(raw))
    silver = M.silver(M.bronze(raw), dim)
    assert rows(layers.read("silver")) == rows(silver.select(*layers.read("silver").columns))
    assert rows(layers.read("gold")) == rows(M.gold(silver))


def test_later_changes_may_come_first_and_a_new_process_goes_on(data):
    layers = data["new"]("any")
    layers.land("customers", data["later"], "b")
    layers.land("orders", data["halves"][1], "b")
    layers.refresh("gold")
    again = data["new"]("any")  # as after a restart: same root, state only in files
    again.land("customers", data["first"], "a")
    again.land("orders", data["halves"][0], "a")
    again.land("orders", data["halves"][0], "a")  # landing a change again adds nothing
    again.refresh("gold")
    check(again, data["raw"], data["dim"])


def test_both_inputs_in_one_query(data):
    layers = data["new"]("one")
    layers.land("customers", data["later"], "b")
    layers.refresh_together()
    assert layers.read("silver").isEmpty()
    layers.land("orders", data["raw"], "all")
    layers.land("customers", data["first"], "a")
    data["new"]("one").refresh_together()
    check(layers, data["raw"], data["dim"])
    with pytest.raises(ValueError, match="together"):
        layers.refresh("gold")


def test_gold_is_pulled_and_a_second_pull_takes_only_what_is_new(data):
    layers = data["new"]("pull")
    layers.land("customers", data["dim"], "all")
    layers.land("orders", data["halves"][0], "a")
    layers.refresh("gold")
    layers.refresh("gold")  # nothing is pending: no batch
    assert layers.refreshes().count() == 3
    layers.land("orders", data["halves"][1], "b")
    before = {r.layer: r for r in layers.status().collect()}
    assert (before["bronze"].pending, before["silver"].pending, before["gold"].pending) == (1, 0, 0)
    layers.refresh("silver")
    status = {r.layer: r for r in layers.status().collect()}
    assert (status["bronze"].pending, status["silver"].pending, status["gold"].pending) == (0, 0, 1)
    layers.refresh("gold")
    second = {r.layer: r for r in layers.refreshes().filter("batch_id = 1").collect()}
    orders = data["halves"][1].select("order_id").distinct().count()
    assert second["bronze"].entries == ["orders/b"] and second["bronze"].rows == data["halves"][1].count()
    assert second["silver"].entries == ["bronze/bronze-1"] and second["silver"].rows == orders
    assert second["gold"].entries == ["silver/silver-1"]
    assert all(r.lag_seconds >= 0 and r.refreshed_at >= r.oldest for r in layers.refreshes().collect())
    check(layers, data["raw"], data["dim"])


def test_layers_with_a_target_run_by_themselves_and_gold_waits(data):
    layers = data["new"]("targets", targets={"bronze": 1, "silver": 2, "gold": None})
    queries = layers.start()
    try:
        layers.land("orders", data["raw"], "all")
        layers.land("customers", data["dim"], "all")
        deadline, pending = time.time() + 120, {}
        while time.time() < deadline and pending != {"bronze": 0, "silver": 0, "gold": pending.get("gold")}:
            time.sleep(1)
            with layers.paused():
                pending = {r.layer: r.pending for r in layers.status().collect()}
        assert pending["gold"] > 0
        assert len(queries) == 2 and layers.tables.gold_table().isEmpty()
    finally:
        for q in queries:
            q.stop()
    layers.refresh("gold")
    check(layers, data["raw"], data["dim"])


@pytest.mark.parametrize("at", ["merge", "publish", "gold"])
def test_silver_cut_off_while_bronze_goes_on_is_exactly_once(data, monkeypatch, at):
    """Silver breaks off at a step; bronze takes the other half; then silver runs its batch again."""
    layers = data["new"]("crash")
    layers.land("customers", data["first"], "a")
    layers.land("orders", data["halves"][0], "a")
    layers.refresh("gold")
    layers.land("customers", data["later"], "b")

    def crash(*args, **kw):
        raise RuntimeError("cut off")

    with monkeypatch.context() as m:
        if at == "merge":
            m.setattr(layers.tables.silver, "_mark", crash)
        elif at == "publish":
            m.setattr(layers, "_publish", crash)
        else:
            m.setattr(layers.tables.gold, "_mark", crash)
        with pytest.raises(Exception, match="cut off"):
            layers.refresh("gold")
    layers.land("orders", data["halves"][1], "b")
    data["new"]("crash").refresh("bronze")
    again = data["new"]("crash")
    again.refresh("gold")
    check(again, data["raw"], data["dim"])


def test_stateful_latest_rows_survive_a_restart(spark, data, tmp):
    raw, src = data["raw"], os.path.join(tmp, "in")
    table = BucketedTable(spark, os.path.join(tmp, "t"), ["order_id"], 2, raw.schema)
    for i in (1, 0):
        data["halves"][i].write.mode("append").parquet(src)
        drain_latest(spark.readStream.schema(raw.schema).parquet(src), table, M.ORDERS_LATEST, os.path.join(tmp, "ckpt"))
    assert rows(table.read().select(*M.BRONZE_COLS)) == rows(M.bronze(raw))


def test_stateful_order_puts_null_above_all_values(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (2, 1, "c"), (2, 3, "d"), (None, 1, "e"), (None, 2, "f")], "k int, o int, v string")
    assert rows(latest_rows(df, ["k"], ["o"])) == rows(spark.createDataFrame([(1, None, "b"), (2, 3, "d"), (None, 2, "f")], df.schema))
