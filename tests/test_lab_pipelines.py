"""Literal rows of the dynamic-table and stream labs: dedup 5 -> 4, NULL
customer group, the merge matrix, change feeds, upsert rules."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import cdc
from strata.operators.merge import (DuplicateSourceKey, When, merge_counts, merge_into, sync_all_columns,
                                    upsert)
from strata.plans import medallion as M

T = dt.datetime
ORDERS_SCHEMA = ("order_id int, customer_id int, product_id int, quantity int, unit_price decimal(10,2), "
                 "order_date date, status string, loaded_at timestamp_ntz, line_no int, supp_id int")


def lab_orders(spark, with_order_5=False):
    d = dt.date
    data = [
        (1, 101, 201, 2, 29.99, d(2026, 1, 15), "PAID", T(2026, 1, 20, 10, 0, 0), 1, 1),
        (2, 102, 202, 1, 99.99, d(2026, 1, 16), "PENDING", T(2026, 1, 20, 10, 0, 0), 1, 1),
        (3, 101, 203, 3, 15.50, d(2026, 1, 17), "SHIPPED", T(2026, 1, 20, 10, 0, 0), 1, 1),
        (4, 103, 201, 1, 29.99, d(2026, 1, 18), "PAID", T(2026, 1, 20, 10, 0, 0), 1, 1),
        (2, 102, 202, 1, 99.99, d(2026, 1, 16), "PAID", T(2026, 1, 20, 10, 0, 1), 1, 1),
    ]
    if with_order_5:
        data.append((5, 102, 204, 2, 45.00, d(2026, 1, 19), "PAID", T(2026, 1, 20, 10, 5, 0), 1, 1))
    from decimal import Decimal

    data = [r[:4] + (Decimal(str(r[4])),) + r[5:] for r in data]
    return spark.createDataFrame(data, ORDERS_SCHEMA)


def lab_dim(spark):
    return spark.createDataFrame(
        [(1, "Alice Chen", "gold", True), (2, "Bob Smith", "platinum", True), (3, "Carol Wu", "platinum", False)],
        "customer_id int, name string, tier string, is_active boolean")


def test_bronze_dedup_keeps_latest(spark):
    b = M.bronze(lab_orders(spark))
    assert b.count() == 4  # deduplicated from 5
    assert rows(b.filter("order_id = 2"), "status") == [("PAID",)]


def test_gold_has_one_null_group_for_unknown_customers(spark):
    g = M.gold(M.silver(M.bronze(lab_orders(spark, with_order_5=True)), lab_dim(spark)))
    out = rows(g, "customer_name", "customer_tier", "total_orders")
    # orders use customers 101-103, the dimension has 1-3: one NULL group (Q09)
    assert out == [(None, None, 5)]


def test_silver_extra_on_condition_nulls_inactive(spark):
    o = lab_orders(spark).withColumn("customer_id", F.lit(3))
    s = M.silver(M.bronze(o), lab_dim(spark))
    assert {r.customer_name for r in s.collect()} == {None}  # Carol is inactive


def test_cancelled_and_null_status_excluded_from_gold(spark):
    o = lab_orders(spark).withColumn("customer_id", F.lit(1))
    o = o.withColumn("status", F.when(F.col("order_id") == 1, "CANCELLED")
                     .when(F.col("order_id") == 3, None).otherwise(F.col("status")))
    g = M.gold(M.silver(M.bronze(o), lab_dim(spark)))
    assert rows(g, "customer_name", "total_orders") == [("Alice Chen", 2)]


# ------------------------------------------------------------------ MERGE --

def _merge_case(spark):
    tgt = spark.createDataFrame(
        [(1, "A", "a@x", "gold", True), (2, "B", "b@x", "standard", True), (4, "D", "d@x", "gold", False)],
        "customer_id int, name string, email string, tier string, is_active boolean")
    src = spark.createDataFrame(
        [(1, "A", "a@x", "gold", "DELETE"), (2, "B2", "b2@x", "platinum", "INSERT"),
         (3, "C", "c@x", "platinum", "INSERT"), (5, "E", "e@x", "gold", "DELETE"),
         (4, "D2", "d2@x", "gold", "INSERT")],
        "customer_id int, name string, email string, tier string, metadata_action string")
    clauses = [
        When(True, "update", F.col("s.metadata_action") == "DELETE", {"is_active": F.lit(False)}),
        When(True, "update", F.col("s.metadata_action") == "INSERT",
             {"name": F.col("s.name"), "email": F.col("s.email"), "tier": F.col("s.tier")}),
        When(False, "insert", F.col("s.metadata_action") == "INSERT",
             {"customer_id": F.col("s.customer_id"), "name": F.col("s.name"), "email": F.col("s.email"),
              "tier": F.col("s.tier")}),
    ]
    return tgt, src, clauses


def test_merge_matrix(spark):
    tgt, src, clauses = _merge_case(spark)
    out = merge_into(tgt, src, ["customer_id"], clauses, {"is_active": F.lit(True)})
    assert rows(out) == [
        (1, "A", "a@x", "gold", False),           # matched + DELETE -> deactivated
        (2, "B2", "b2@x", "platinum", True),      # matched + INSERT -> updated
        (3, "C", "c@x", "platinum", True),        # not matched + INSERT -> inserted with default
        (4, "D2", "d2@x", "gold", False),         # update never re-activates (Q07)
    ]                                             # not matched + DELETE (5) ignored


def test_merge_counts(spark):
    tgt, src, clauses = _merge_case(spark)
    c = merge_counts(merge_into(tgt, src, ["customer_id"], clauses, with_action=True)).first()
    assert (c.rows_inserted, c.rows_updated, c.rows_deleted, c.rows_affected) == (1, 3, 0, 4)


def test_merge_delete_clause_removes_rows(spark):
    tgt, src, _ = _merge_case(spark)
    out = merge_into(tgt, src, ["customer_id"], [When(True, "delete", F.col("s.metadata_action") == "DELETE")])
    assert [r.customer_id for r in out.orderBy("customer_id").collect()] == [2, 4]


def test_upsert_rejects_repeated_source_keys(spark):
    tgt, src, _ = _merge_case(spark)
    dup = src.unionByName(src.limit(1)).drop("metadata_action")
    with pytest.raises(DuplicateSourceKey):
        upsert(tgt.drop("is_active"), dup, ["customer_id"])


def test_schema_sync_adds_and_drops(spark):
    tgt = spark.createDataFrame([(1, "a", "x")], "id int, name string, old string")
    inc = spark.createDataFrame([(1, "b", 7)], "id int, name string, extra int")
    s = sync_all_columns(tgt, inc)
    assert s.columns == ["id", "name", "extra"] and s.first().extra is None
    assert rows(upsert(s, inc, ["id"])) == [(1, "b", 7)]


# -------------------------------------------------------------------- CDC --

def _random_table(rng, n, key_space):
    ids = rng.sample(range(key_space), n)
    return [(i, rng.choice(["a", "b", None]), rng.randint(0, 3)) for i in ids]


def test_change_feed_applied_to_old_gives_new(spark):
    """Property: apply(diff(old, new), old) == new, on random keyed tables."""
    rng = random.Random(7)
    schema = "k int, s string, v int"
    for _ in range(5):
        old = spark.createDataFrame(_random_table(rng, 30, 50), schema)
        new = spark.createDataFrame(_random_table(rng, 30, 50), schema)
        feed = cdc.collapse_feed(cdc.change_feed(old, new, ["k"]), ["k"])
        vals = {c: F.col(f"s.{c}") for c in ("k", "s", "v")}
        applied = merge_into(old, feed, ["k"], [
            When(True, "delete", (F.col(f"s.{cdc.ACTION}") == "DELETE")),
            When(True, "update", (F.col(f"s.{cdc.ACTION}") == "INSERT"), vals),
            When(False, "insert", (F.col(f"s.{cdc.ACTION}") == "INSERT"), vals),
        ])
        assert rows(applied) == rows(new)


def test_update_is_delete_plus_insert(spark):
    old = spark.createDataFrame([(1, "Alice", "gold"), (2, "Bob", "standard"), (3, "Carol", "platinum")],
                                "customer_id int, name string, tier string")
    new = spark.createDataFrame([(1, "Alice", "gold"), (2, "Bob", "platinum")],
                                "customer_id int, name string, tier string")
    f = cdc.change_feed(old, new, ["customer_id"])
    assert rows(f) == [(2, "Bob", "platinum", "INSERT", True), (2, "Bob", "standard", "DELETE", True),
                       (3, "Carol", "platinum", "DELETE", False)]
    assert rows(cdc.collapse_feed(f, ["customer_id"]), "customer_id", cdc.ACTION) == [(2, "INSERT"), (3, "DELETE")]
    assert cdc.has_data(f).first().has_data is True
    assert cdc.has_data(f.limit(0)).first().has_data is False


def test_keyless_feed_of_lab_inserts(spark):
    """ids 1-3 inserted twice, 2 updated, 3 deleted (Q03): net feed = 4 inserts."""
    empty = spark.createDataFrame([], "customer_id int, name string, tier string")
    now = spark.createDataFrame([(1, "Alice", "gold"), (1, "Alice", "gold"), (2, "Bob", "platinum"),
                                 (2, "Bob", "platinum")], "customer_id int, name string, tier string")
    f = cdc.change_feed(empty, now, None)
    assert f.count() == 4 and {r[cdc.ACTION] for r in f.collect()} == {"INSERT"}


def test_latest_treats_null_as_first_in_desc(spark):
    """SQL default: DESC puts NULLs first (Q12), so a NULL load time wins."""
    from strata.operators.relational import latest_per_key

    df = spark.createDataFrame([(1, T(2026, 1, 1), "a"), (1, None, "b"), (2, T(2026, 1, 1), "c")],
                               "k int, ts timestamp_ntz, v string")
    assert rows(latest_per_key(df, ["k"], ["ts"]), "k", "v") == [(1, "b"), (2, "c")]


def test_change_feed_across_added_column(spark):
    """ADD COLUMN between snapshots: rows whose new column got a value are updates."""
    old = spark.createDataFrame([(1, "Alice"), (2, "Bob")], "customer_id int, name string")
    new = spark.createDataFrame([(1, "Alice", None), (2, "Bob", "bob@example.com")],
                                "customer_id int, name string, email_address string")
    f = cdc.change_feed(old, new, ["customer_id"])
    assert rows(f, "customer_id", cdc.ACTION) == [(2, "DELETE"), (2, "INSERT")]


def test_change_feed_null_and_repeated_keys(spark):
    """Unchanged rows with a NULL or a repeated key give no changes."""
    old = spark.createDataFrame([(None, "a"), (1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (1, "y"), (1, "x"), (2, "w"), (None, "m")], "k int, v string")
    feed = {tuple(r) for r in cdc.change_feed(old, new, ["k"]).collect()}
    assert feed == {(None, "m", "INSERT", True), (None, "n", "DELETE", True), (2, "w", "INSERT", True), (2, "z", "DELETE", True)}
