"""dbt-style models, the bucketed store and the size-checked helpers."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata.operators.joins import broadcast_if_small, row_count_at_most, semi_join_or_null
from strata.operators.merge import DuplicateSourceKey, upsert
from strata.operators.quality import not_null_failures, run_checks, unique_failures
from strata.operators.relational import latest_per_key, with_high_water
from strata.plans import dbt_models as dbt
from strata.sources.store import BucketedTable


def test_stg_customers_cleans_and_filters(spark):
    raw = spark.createDataFrame(
        [(1, "  Alice Chen ", " ALICE@X.COM", "gold", None), (None, "x", "y", "z", None)],
        "customer_id int, name string, email string, tier string, updated_at timestamp")
    assert rows(dbt.stg_customers(raw), "customer_id", "customer_name", "customer_email", "customer_tier") == [
        (1, "alice chen", "alice@x.com", "GOLD")]


def test_materialize_incremental_upserts_and_syncs_schema(spark, tmp):
    path = os.path.join(tmp, "fct")
    v1 = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "order_id int, s string, x int")
    dbt.materialize(spark, v1, "fct", "incremental", path, unique_key=("order_id",))
    v2 = spark.createDataFrame([(2, "B", 5), (3, "c", 6)], "order_id int, s string, y int")  # x gone, y new
    out = dbt.materialize(spark, v2, "fct", "incremental", path, unique_key=("order_id",))
    assert out.columns == ["order_id", "s", "y"]
    assert rows(out) == [(1, "a", None), (2, "B", 5), (3, "c", 6)]
    with pytest.raises(DuplicateSourceKey):
        dbt.materialize(spark, v2.unionByName(v2), "fct", "incremental", path, unique_key=("order_id",))
    view = dbt.materialize(spark, v1, "fct_view", "view")
    assert view.count() == 2


def test_fct_orders_full_then_incremental_equals_one_run(spark, tmp):
    from strata.sources import derived as D

    raw = D.orders_raw(spark, SF001)
    stg_c = dbt.stg_customers(D.customers(spark, SF001).withColumn("updated_at", F.current_timestamp()))
    cut = F.lit("1995-01-01").cast("timestamp_ntz")

    def dedup(df):
        return latest_per_key(df, ["order_id"], ["loaded_at", "line_no", "product_id", "supp_id"]).drop(
            "line_no", "supp_id")

    path = os.path.join(tmp, "fct_orders")
    dbt.fct_orders_run(spark, raw.filter(F.col("loaded_at") <= cut), stg_c, path, dedup=dedup)
    inc = dbt.fct_orders_run(spark, raw, stg_c, path, dedup=dedup)
    one = dbt.fct_orders_enrich(dedup(raw), stg_c)
    assert rows(inc) == rows(one.select(*inc.columns))


def test_high_water_empty_target_loads_all(spark):
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, ts timestamp")
    empty = src.limit(0)
    assert with_high_water(src, empty, "ts").count() == 2
    assert rows(with_high_water(src, src.filter("id = 1"), "ts"), "id") == [(2,)]


def test_bucketed_store_merge_replay_and_emptied_bucket(spark, tmp):
    t = BucketedTable(spark, os.path.join(tmp, "t"), ["k"], buckets=4)
    t.write(spark.createDataFrame([(i, i * 10) for i in range(20)], "k int, v int"))
    src = spark.createDataFrame([(3, 1), (25, 2)], "k int, v int")
    assert t.merge(src, lambda a, b: upsert(a, b, ["k"]), batch_id="b1", may_delete=False)
    assert not t.merge(src.withColumn("v", F.lit(99)), lambda a, b: upsert(a, b, ["k"]), batch_id="b1")
    got = dict((r.k, r.v) for r in t.read().collect())
    assert got[3] == 1 and got[25] == 2 and len(got) == 21
    # delete every key of one bucket: the bucket directory must disappear
    b0 = [r.k for r in t.read().withColumn("b", t.bucket_of()).filter("b = 0").collect()]
    keys = spark.createDataFrame([(k,) for k in b0], "k int")
    t.merge(keys, lambda a, b: a.join(b, "k", "left_anti"), batch_id="b2")
    assert t.read().count() == 21 - len(b0)


def test_bound_checks(spark):
    small = spark.range(10)
    assert row_count_at_most(small, 10) and not row_count_at_most(small, 9)
    assert broadcast_if_small(small, 5) is small          # above the bound: unchanged
    assert broadcast_if_small(small, 100) is not small    # proven small: broadcast hint added
    left = spark.createDataFrame([(1, "US"), (2, None)], "id int, r string")
    only_null = spark.createDataFrame([(None,)], "region string")
    assert rows(semi_join_or_null(left, only_null, "r", "region"), "id") == [(1,), (2,)]
    none = spark.createDataFrame([], "region string")
    assert semi_join_or_null(left, none, "r", "region").count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert not_null_failures(df, "id").count() == 1
    assert rows(unique_failures(df, "id")) == [(1, 2)]
    res = {(r.check_name, r.column_name): (r.failures, r.status) for r in
           run_checks({"t": df}, [("not_null", "t", "id"), ("unique", "t", "id")]).collect()}
    assert res == {("not_null", "id"): (1, "fail"), ("unique", "id"): (1, "fail")}


def test_merge_procedure_gate_and_message(spark, tmp):
    from strata.operators import cdc
    from strata.plans.catalog_models import lab_merge_clauses, lab_merge_defaults

    dim_rows = [(1, "A", "a@x", "gold", True, dt.datetime(2024, 1, 1)),
                (2, "B", "b@x", "standard", True, dt.datetime(2024, 1, 1))]
    schema = "customer_id long, name string, email string, tier string, is_active boolean, loaded_at timestamp_ntz"
    dim = BucketedTable(spark, os.path.join(tmp, "dim"), ["customer_id"], buckets=4)
    dim.write(spark.createDataFrame(dim_rows, schema))
    old = spark.createDataFrame([(1, "A", "a@x", "gold"), (2, "B", "b@x", "standard")],
                                "customer_id long, name string, email string, tier string")
    assert dbt.merge_customers(spark, cdc.change_feed(old, old, ["customer_id"]), dim, lab_merge_clauses(),
                               lab_merge_defaults()) == "No new data in stream"
    new = spark.createDataFrame([(2, "B", "b@x", "platinum"), (3, "C", "c@x", "gold")],
                                "customer_id long, name string, email string, tier string")
    msg = dbt.merge_customers(spark, cdc.change_feed(old, new, ["customer_id"]), dim, lab_merge_clauses(),
                              lab_merge_defaults(), batch_id="m1")
    assert msg == "Merge complete: 3 rows affected"  # 1 deactivated, 2 updated, 3 inserted
    assert rows(dim.read(), "customer_id", "tier", "is_active") == [(1, "gold", False), (2, "platinum", True),
                                                                  (3, "gold", True)]


def test_skew_safe_rank_equals_window_rank(spark):
    import random

    from strata.operators.relational import rank_within

    rng = random.Random(5)
    data = [(0 if rng.random() < 0.7 else rng.randint(1, 3), rng.choice([None, *range(20)]), i) for i in range(600)]
    df = spark.createDataFrame(data, "g int, v int, id int")
    for desc in (True, False):
        safe = rows(rank_within(df, ["g"], "v", "r", descending=desc), "id", "r")
        plain = rows(rank_within(df, ["g"], "v", "r", descending=desc, skew_safe=False), "id", "r")
        assert safe == plain


def test_change_stream_consumes_each_change_once(spark, tmp):
    from strata.operators import cdc
    from strata.sources.change_stream import ChangeStream

    schema, path = "id long, v string", os.path.join(tmp, "stream")
    at = [spark.createDataFrame(r, schema) for r in ([(1, "a"), (None, "n")], [(1, "b"), (None, "n")], [(2, "c"), (None, "n")])]
    seen = []

    def take(feed, batch_id):
        seen.append((batch_id, rows(feed, "id", "v", cdc.ACTION, cdc.IS_UPDATE)))
        return len(seen[-1][1])

    def crash(feed, batch_id):
        take(feed, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(ValueError):
        ChangeStream(spark, path, ["id"]).consume(at[0], take)
    ChangeStream(spark, path, ["id"]).create(at[0]).create(at[1])  # the second one changes nothing
    assert ChangeStream(spark, path, ["id"]).consume(at[0], take) == 0
    with pytest.raises(RuntimeError):
        ChangeStream(spark, path, ["id"]).consume(at[1], crash)
    assert ChangeStream(spark, path, ["id"]).consume(at[2], take) == 2  # the snapshot of the call that broke off
    assert seen[1] == seen[2] == ("offset-2", [(1, "a", "DELETE", True), (1, "b", "INSERT", True)])
    assert ChangeStream(spark, path, ["id"]).consume(at[2], take) == 2
    assert seen[-1] == ("offset-3", [(1, "b", "DELETE", False), (2, "c", "INSERT", False)])
    assert ChangeStream(spark, path, ["id"]).consume(at[2], take) == 0


def test_change_stream_reads_only_the_buckets_that_differ(spark, tmp):
    from strata.operators import cdc
    from strata.sources import change_stream as cs
    from strata.sources import files

    path = os.path.join(tmp, "digests")
    old = spark.range(200).selectExpr("id", "cast(id % 3 as string) v", "array(id, null) a").unionByName(
        spark.sql("SELECT cast(null as bigint) id, 'n' v, array(1L, null) a FROM range(3)"))
    new = old.withColumn("v", F.when(F.col("id") == 7, F.lit("x")).otherwise(F.col("v")))
    stream = cs.ChangeStream(spark, path, ["id"], buckets=32).create(old)
    plans = []

    def take(feed, batch_id):
        plans.append(feed._jdf.queryExecution().explainString(feed.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        return rows(feed, "id", "v", cdc.ACTION, cdc.IS_UPDATE)

    assert stream.consume(old, take) == [] and stream.changed == []
    assert files.names(spark, stream.rows) == [f"{cs.VERSION}=0"]  # nothing was copied
    assert cs.ChangeStream(spark, path, ["id"], buckets=5).consume(new, take) == [(7, "1", "DELETE", True), (7, "x", "INSERT", True)]
    assert len(files.names(spark, f"{stream.rows}/{cs.VERSION}=2")) <= 3  # one bucket (and markers)
    assert plans[-1].count("PartitionFilters") >= 1 and cs.BUCKET in plans[-1].split("PartitionFilters")[1].split("\n")[0]
    # an empty column changes no digest; a value in it does; nulls that trade places do
    wider = new.withColumn("w", F.lit(None).cast("int"))
    assert stream.consume(wider, take) == [] and stream.changed == []
    filled = wider.withColumn("w", F.when(F.col("id") == 9, F.lit(1)))
    assert stream.consume(filled, take) == [(9, "0", "DELETE", True), (9, "0", "INSERT", True)]
    swapped = filled.withColumn("a", F.when(F.col("id") == 3, F.array(F.lit(None).cast("long"), F.col("id"))).otherwise(F.col("a")))
    assert stream.consume(swapped, take) == [(3, "0", "DELETE", True), (3, "0", "INSERT", True)]
    # repeated rows count; a type change reaches every bucket; the table may become empty
    fewer = swapped.filter("id is not null").unionByName(swapped.filter("id is null").limit(1))
    assert stream.consume(fewer, take) == [(None, "n", "DELETE", False)] * 2
    assert stream.consume(fewer.withColumn("w", F.col("w").cast("long")), take) == []  # same values in a wider type
    assert {a for _, _, a, _ in stream.consume(fewer.limit(0), take)} == {"DELETE"}
    assert stream.consume(fewer.limit(0), take) == []
    assert stream.consume(fewer, take) and stream.consume(fewer, take) == []
    with pytest.raises(ValueError):
        cs.ChangeStream(spark, path + "-clash", ["id"]).create(old.withColumnRenamed("v", cs.BUCKET))


def test_change_stream_without_keys_counts_repeated_rows(spark, tmp):
    from strata.operators import cdc
    from strata.sources.change_stream import ChangeStream

    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "id long, v string")
    stream = ChangeStream(spark, os.path.join(tmp, "bag"), []).create(df)
    later = spark.createDataFrame([(None, "a"), (1, None), (1, None)], "id long, v string")
    assert stream.consume(later, lambda f, _: rows(f, "id", "v", cdc.ACTION, cdc.IS_UPDATE)) == [
        (1, None, "INSERT", False), (None, "a", "DELETE", False)]


def test_merge_spreads_rows_without_a_key(spark):
    from strata.operators.merge import When, merge_into

    schema = "id long, v string"
    t = spark.createDataFrame([(1, "a"), (None, "x"), (None, "y")], schema)
    s = spark.createDataFrame([(1, "b"), (None, "x"), (2, "c")], schema)
    both = {c: F.col(f"s.{c}") for c in ("id", "v")}
    merged = merge_into(t, s, ["id"], [When(True, "update", set=both), When(False, "insert", set=both)])
    assert sorted(map(str, rows(merged, "id", "v"))) == sorted(map(str, [(1, "b"), (2, "c"), (None, "x"), (None, "x"), (None, "y")]))


def test_table_keeps_its_bucket_count(spark, tmp):
    path, df = os.path.join(tmp, "t"), spark.range(100).withColumnRenamed("id", "k")
    BucketedTable(spark, path, ["k"], buckets=3).write(df)
    later = BucketedTable(spark, path, ["k"], buckets=16)
    later.merge(df.withColumn("k", F.col("k") + 50), lambda t, s: t.unionByName(s).distinct())
    assert later.buckets == 3 and later.read().count() == 150
    assert spark.read.parquet(path).select("_b").distinct().count() == 3
