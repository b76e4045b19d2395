"""The session's role, column defaults, stored scripts and tags."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from strata.operators import session_policies as SP
from strata.operators import tags as TG
from strata.operators.governance import TagError
from strata.plans import catalog_session as CS
from strata.sources import derived as D


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "Ann@x.org", "gold", "EU"), (2, None, "standard", "US"), (3, "b@c@y.org", None, None)],
                                 "id int, email string, tier string, region string")


def test_one_view_follows_the_role(spark, people):
    SP.install(spark)
    SP.secure(spark, "people_secured", people, {"email": "email_mask", "tier": "tier_mask"})
    assert SP.current_role(spark) == "PUBLIC"
    want = {"SYSADMIN": [("Ann@x.org", "gold"), (None, "standard"), ("b@c@y.org", None)],
            "ANALYST_FR": [("****@x.org", "***"), (None, "***"), ("****@y.org", "***")],
            "PUBLIC": [("***REDACTED***", None)] * 3, "it's": [("***REDACTED***", None)] * 3}
    for role, seen in want.items():
        SP.use_role(spark, role)
        assert rows(spark.table("people_secured"), "id", "email", "tier") == [(i, *s) for i, s in enumerate(seen, 1)]
    SP.use_role(spark, "ANALYST_FR")
    # a user's filter sees masked values only
    assert spark.table("people_secured").filter("email = 'Ann@x.org' OR tier = 'gold'").count() == 0
    before = spark.table("people_secured")
    SP.use_role(spark, "SYSADMIN")
    assert before.filter("id = 1").first().email == "****@x.org"  # analysed as the analyst


def test_rows_by_region_and_wildcard(spark, people):
    SP.install(spark)
    spark.createDataFrame([("ANALYST_FR", "EU"), ("DATA_ENGINEER_FR", None), ("OTHER", "US"), ("OTHER", "EU")],
                          "role_name string, region string").createOrReplaceTempView("people_access")
    SP.secure(spark, "people_rows", people, region_col="region", access_map="people_access")
    want = {"ACCOUNTADMIN": [1, 2, 3], "ANALYST_FR": [1], "DATA_ENGINEER_FR": [1, 2, 3], "OTHER": [1, 2], "PUBLIC": []}
    for role, ids in want.items():
        SP.use_role(spark, role)
        assert [r[0] for r in rows(spark.table("people_rows"), "id")] == ids


def test_filters_reach_the_scan_below_the_masks(spark):
    SP.install(spark, "ANALYST_FR")
    path = f"{SF001}/customer.parquet"
    SP.secure(spark, "customers_masked", spark.read.parquet(path).select("c_custkey", F.col("c_name").alias("email"), "c_mktsegment"), {"email": "email_mask"})
    plan = spark.table("customers_masked").filter("c_custkey < 5")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(c_custkey,5)" in plan
    assert "session" not in plan and "CASE" not in plan  # the role is folded
    narrow = spark.table("customers_masked").select("c_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in narrow


def test_table_defaults_and_their_time(spark):
    began = dt.datetime.now(dt.timezone.utc)
    name = CS.customers_with_defaults(spark, SF001)
    ended = dt.datetime.now(dt.timezone.utc)
    t = spark.table(name)
    stamped = t.filter("customer_id % 2 = 0")
    assert stamped.select("updated_at").distinct().count() == 2  # one time per insert
    assert stamped.filter(~F.col("updated_at").between(F.lit(began), F.lit(ended))).isEmpty()
    assert t.filter("customer_id % 2 = 1").select("updated_at").distinct().count() == 1
    assert t.filter("region IS NULL").isEmpty() and t.filter("customer_id < 1000000 AND region <> 'US'").isEmpty()
    spark.sql(f"INSERT INTO {name} VALUES (-1, 'x', 'y', DEFAULT, DEFAULT, DEFAULT)")
    row = t.sparkSession.table(name).filter("customer_id = -1").first()
    assert (row.tier, row.region) == ("standard", "US") and row.updated_at is not None


def test_a_script_that_fails_leaves_the_dimension(spark):
    dim = spark.createDataFrame([(1, "a", "a@x", "gold", True, dt.datetime(2024, 1, 1))],
                                "customer_id long, name string, email string, tier string, is_active boolean, loaded_at timestamp_ntz")
    procedure = CS.MergeProcedure(spark, dim)
    feed = spark.createDataFrame([(1, "b", "b@x", "gold", "INSERT", True), (2, "c", "c@x", "gold", "DELETE", False)],
                                 "customer_id long, name string, email string, tier string, metadata_action string, metadata_isupdate boolean")
    with pytest.raises(RuntimeError, match="Merge failed"):
        procedure(feed.withColumn("name", F.raise_error(F.lit("broken"))), "b")
    assert rows(procedure.dim()) == rows(dim)
    assert procedure(feed, "b") == "Merge complete: 1 rows affected"
    assert rows(procedure.dim(), "customer_id", "name", "is_active") == [(1, "b", True)]
    assert procedure(feed.limit(0), "c") == "No new data in stream"
    assert CS.call_script(spark, "BEGIN DECLARE x INT DEFAULT 2; SELECT x + 1; END") == 3


def test_tags_take_allowed_values_only(spark, tmp):
    tags = TG.TagTable(spark, tmp)
    ref = spark.createDataFrame([("t", "a", "PII_TAG", "EMAIL"), ("t", "a", "PII_TAG", "EMAIL"), ("u", "b", "PII_TAG", "NAME")], TG.TagTable.SCHEMA)
    tags.set(ref)
    tags.set(ref)
    assert rows(TG.TagTable(spark, tmp).references()) == [("t", "a", "PII_TAG", "EMAIL"), ("u", "b", "PII_TAG", "NAME")]
    assert rows(tags.of("u"), "column_name") == [("b",)]
    for bad in (("t", "c", "PII_TAG", "SHOE_SIZE"), ("t", "c", "OTHER_TAG", "EMAIL")):
        with pytest.raises(TagError):
            tags.set(spark.createDataFrame([bad, ("t", "z", "PII_TAG", "NAME")], TG.TagTable.SCHEMA))
    assert tags.references().count() == 2


def test_profile_counts_whole_and_part(spark):
    df = spark.createDataFrame([(1, "a@b.org", "call +1 (743) 555-3824 or a@b.org"), (2, "x", None), (3, None, "12 Main Street")], "k int, e string, t string")
    found = {(r.column_name, r.tag_value): (r.n_values, r.whole, r.part) for r in TG.profile(df, "d").collect()}
    assert found["e", "EMAIL"] == (2, 1, 1) and found["t", "EMAIL"] == (2, 0, 1) and found["t", "PHONE"] == (2, 0, 1) and found["t", "ADDRESS"] == (2, 1, 1)
    assert TG.profile(df.select("k"), "d").isEmpty() and TG.propose(TG.profile(df.limit(0), "d")).isEmpty()


def test_metadata_survives_projection_filter_and_join(spark, people):
    refs = spark.createDataFrame([("p", "email", "PII_TAG", "EMAIL"), ("p", "gone", "PII_TAG", "NAME")], TG.TagTable.SCHEMA)
    t = TG.tagged(people, refs)
    out = t.filter("id > 0").join(people.select("id", F.col("email").alias("plain")), "id").select(F.col("email").alias("mail"), "plain", F.lower("email").alias("low"))
    assert rows(TG.tags_of(out, "q")) == [("q", "mail", "PII_TAG", "EMAIL")]
    again = TG.tagged(t, spark.createDataFrame([("p", "email", "X", "1")], TG.TagTable.SCHEMA))
    assert again.schema["email"].metadata["tags"] == {"PII_TAG": ["EMAIL"], "X": ["1"]}


def test_tags_read_their_rows_once(spark, tmp):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    refs = spark.createDataFrame([("t", c, "PII_TAG", "NAME") for c in "abcdef"], TG.TagTable.SCHEMA).repartition(2)
    TG.TagTable(spark, tmp).set(refs.mapInPandas(counted, TG.TagTable.SCHEMA))
    assert seen.value == 6 and TG.TagTable(spark, tmp).references().count() == 6


def test_profile_looks_for_every_pattern(spark):
    values = {"EMAIL": "a.b@c.de", "SSN": "123-45-6789", "PHONE": "+1 (555) 555-1234", "NAME": "Customer#000000001", "ADDRESS": "12 Long Street"}
    df = spark.createDataFrame([(v,) for v in values.values()] + [(f"x, {v} y",) for v in values.values()] + [(None,), ("",)], "t string")
    assert {r.tag_value: (r.n_values, r.whole, r.part) for r in TG.profile(df, "d").collect()} == {k: (11, 1, 2) for k in values}
