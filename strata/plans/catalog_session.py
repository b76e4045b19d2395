"""What a warehouse keeps in the session and the catalog: the current role,
column defaults, empty copies, stored scripts and tags (F11, F12, S09, S10,
X02, X06, G06-G08)."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import session_policies as SP
from strata.operators import tags as TG
from strata.operators.cdc import collapse_feed
from strata.plans import catalog_gov as G
from strata.plans import catalog_models as CM
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path
from strata.sources import derived as D
from strata.sources.change_stream import ChangeStream
from strata.sources.tables import TABLES, table


def new_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:10]}"


# ------------------------------------------------------------ the current role --

@register("f12_session_role_masks", with_("customers") + G._masked_sql())
def f12_masks(spark, sf):
    """One secured view, read by four roles in turn."""
    SP.install(spark)
    view = new_name("customers_secured")
    SP.secure(spark, view, D.customers(spark, sf).select("customer_id", "name", F.col("email").alias("email_address"), "tier"),
              {"email_address": "email_mask", "tier": "tier_mask"})
    return _as_each_role(spark, view)


@register("f12_session_role_rows", with_("bronze", "customers", extra=G._ORDERS_REGION_SQL) + G._row_access_sql())
def f12_rows(spark, sf):
    SP.install(spark)
    view, access = new_name("orders_secured"), new_name("region_access_map")
    G.access_map(spark).createOrReplaceTempView(access)
    path = scratch_path(spark, "orders_with_region")
    G.orders_with_region(spark, sf).select("order_id", "customer_id", "region", "status").write.parquet(path)
    SP.secure(spark, view, spark.read.parquet(path), region_col="region", access_map=access)
    return _as_each_role(spark, view)


def _as_each_role(spark, view: str) -> DataFrame:
    seen = []
    for role in G.ROLES:
        SP.use_role(spark, role)
        seen.append(spark.table(view).select(F.lit(SP.current_role(spark)).alias("role_name"), "*"))
    SP.use_role(spark, "PUBLIC")
    return reduce(DataFrame.unionByName, seen)


# ------------------------------------------------ defaults that the table applies --

GIVEN = "2024-01-15 00:00:00"


def customers_with_defaults(spark, sf) -> str:
    """A catalog table filled by an insert that names columns and one that gives all; a column is added after."""
    name = new_name("customers")
    D.customers(spark, sf).createOrReplaceTempView(f"{name}_source")
    spark.sql(f"""CREATE TABLE {name} (customer_id BIGINT, name STRING, email STRING, tier STRING DEFAULT 'standard',
                  updated_at TIMESTAMP DEFAULT current_timestamp()) USING parquet LOCATION '{scratch_path(spark, name)}'""")
    spark.sql(f"INSERT INTO {name} (customer_id, name, email) SELECT customer_id, name, email FROM {name}_source WHERE customer_id % 2 = 0")
    spark.sql(f"INSERT INTO {name} SELECT customer_id, name, email, tier, TIMESTAMP '{GIVEN}' FROM {name}_source WHERE customer_id % 2 = 1")
    spark.sql(f"ALTER TABLE {name} ADD COLUMN region STRING DEFAULT 'US'")  # files written before read the default
    spark.sql(f"INSERT INTO {name} (customer_id, region) SELECT customer_id + 1000000, region FROM {name}_source WHERE customer_id % 100 = 0")
    return name


@register("f11_s10_table_defaults", with_("customers") + f"""
SELECT customer_id, name, email, CASE customer_id % 2 WHEN 0 THEN 'standard' ELSE tier END AS tier, 'US' AS region,
       CASE customer_id % 2 WHEN 1 THEN TIMESTAMP '{GIVEN}' END AS given_at, customer_id % 2 = 0 AS stamped_now
FROM customers
UNION ALL SELECT customer_id + 1000000, NULL, NULL, 'standard', region, NULL, TRUE FROM customers WHERE customer_id % 100 = 0""")
def f11_defaults(spark, sf):
    began = dt.datetime.now(dt.timezone.utc)
    now = F.col("updated_at") >= F.lit(began)
    return spark.table(customers_with_defaults(spark, sf)).select(
        "customer_id", "name", "email", "tier", "region", F.when(~now, F.col("updated_at").cast("timestamp_ntz")).alias("given_at"), now.alias("stamped_now"))


@register("s09_empty_copy_filled", with_("customers") + f"""
SELECT customer_id, name, tier, 0 AS rows_before FROM customers WHERE customer_id % 2 = 1""")
def s09_copy(spark, sf):
    """An empty copy of a table's structure, defaults and all, filled by name."""
    name = customers_with_defaults(spark, sf)
    copy = f"{name}_copy"
    spark.sql(f"CREATE TABLE {copy} LIKE {name} USING parquet LOCATION '{scratch_path(spark, copy)}'")
    before = spark.table(copy).count()
    spark.sql(f"INSERT INTO {copy} BY NAME SELECT tier, name, customer_id FROM {name} WHERE customer_id % 2 = 1")
    return spark.table(copy).select("customer_id", "name", "tier", F.lit(before).cast("int").alias("rows_before"))


# ------------------------------------------------------------- a stored script --

MERGE_SCRIPT = """
BEGIN
  DECLARE message STRING DEFAULT 'No new data in stream';
  DECLARE EXIT HANDLER FOR SQLEXCEPTION
    BEGIN
      SELECT 'Merge failed' AS message;
    END;
  IF EXISTS (SELECT 1 FROM {changes}) THEN
    INSERT OVERWRITE TABLE {target}
      SELECT coalesce(t.customer_id, s.customer_id),
             merged_value(t.present, s.metadata_action, t.name, s.name),
             merged_value(t.present, s.metadata_action, t.email, s.email),
             merged_value(t.present, s.metadata_action, t.tier, s.tier),
             CASE WHEN t.present AND s.metadata_action = 'DELETE' THEN FALSE WHEN t.present THEN t.is_active ELSE TRUE END,
             CASE WHEN s.metadata_action = 'INSERT' THEN {now} ELSE t.loaded_at END,
             s.metadata_action IS NOT NULL
      FROM (SELECT *, TRUE AS present FROM {dim}) t FULL OUTER JOIN {changes} s ON t.customer_id = s.customer_id
      WHERE t.present OR s.metadata_action = 'INSERT';
    SET message = 'Merge complete: ' || (SELECT count(*) FROM {target} WHERE affected) || ' rows affected';
  END IF;
  SELECT message;
END"""


def call_script(spark, script: str) -> str:
    """Run a SQL script; the value its last statement returns."""
    before = spark.conf.get("spark.sql.scripting.enabled")
    spark.conf.set("spark.sql.scripting.enabled", "true")
    try:
        return spark.sql(script).first()[0]
    finally:
        spark.conf.set("spark.sql.scripting.enabled", before)


class MergeProcedure:
    """The customer merge as a SQL script over the dimension's versions: a
    call writes the next version of the whole table, and ``dim`` names the last one."""

    def __init__(self, spark, dim: DataFrame):
        self.spark, self.name = spark, new_name("dim_customers")
        spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION merged_value(present BOOLEAN, action STRING, stored STRING, new STRING) RETURNS STRING
            RETURN CASE WHEN present AND action = 'INSERT' THEN new WHEN present THEN stored ELSE new END""")
        dim.createOrReplaceTempView(self.name)

    def __call__(self, feed: DataFrame, batch_id: str) -> str:
        changes, target = new_name("changes"), new_name("dim_next")
        collapse_feed(feed, ["customer_id"]).createOrReplaceTempView(changes)
        self.spark.sql(f"""CREATE TABLE {target} (customer_id BIGINT, name STRING, email STRING, tier STRING, is_active BOOLEAN,
                           loaded_at TIMESTAMP_NTZ, affected BOOLEAN) USING parquet LOCATION '{scratch_path(self.spark, target)}'""")
        message = call_script(self.spark, MERGE_SCRIPT.format(changes=changes, target=target, dim=self.name, now=f"TIMESTAMP_NTZ '{CM.T1}'"))
        if message == "Merge failed":
            raise RuntimeError(message)  # the stream's offset stays where it is
        if message.startswith("Merge complete"):
            self.spark.table(target).drop("affected").createOrReplaceTempView(self.name)
        return message

    def dim(self) -> DataFrame:
        return self.spark.table(self.name)


@register("x06_x02_merge_script", with_("customers", extra=CM._MERGE_ALL) + """
SELECT customer_id, name, email, tier, is_active, loaded_at,
       'Merge complete: ' || (SELECT COUNT(*) FILTER (WHERE merge_action <> 'unchanged') FROM merged) || ' rows affected' AS first_call,
       'No new data in stream' AS second_call
FROM merged""")
def x06_script(spark, sf):
    """The merge procedure as a SQL script, called twice on a stream with a stored offset."""
    old, new = CM._snapshots(spark, sf)
    procedure = MergeProcedure(spark, CM._dim_target(spark, sf))
    stream = ChangeStream(spark, scratch_path(spark, "customer-stream"), ["customer_id"]).create(old)
    first, second = stream.consume(new, procedure), stream.consume(new, procedure)
    return procedure.dim().select("*", F.lit(first).alias("first_call"), F.lit(second).alias("second_call"))


# ------------------------------------------------------------------------- tags --

# the text columns of the given tables (fixed values, for the SQL twin), and those of the derived customers
_TEXT_COLUMNS = {
    "benchmark": ("text",), "conversations": ("role", "text"), "customer": ("c_name", "c_mktsegment"), "documents": ("text", "lang", "source"),
    "events": ("event_type", "props"), "lineitem": ("l_returnflag", "l_linestatus"), "nation": ("n_name",), "orders": ("o_orderstatus", "o_orderpriority"),
    "pages": ("url", "html"), "part": ("p_name", "p_brand", "p_type"), "region": ("r_name",), "supplier": ("s_name",),
    "customers": ("name", "email", "tier", "region"),
}


def _profile_sql() -> str:
    rows = []
    for name, columns in _TEXT_COLUMNS.items():
        for c in columns:
            for kind, pattern in TG.PATTERNS.items():
                rows.append(f"SELECT '{name}' AS object_name, '{c}' AS column_name, '{kind}' AS tag_value, count({c}) AS n_values, "
                            f"count(*) FILTER (regexp_matches({c}, '^({pattern})$')) AS whole, count(*) FILTER (regexp_matches({c}, '{pattern}')) AS part FROM {name}")
    return "\nUNION ALL\n".join(rows)


_TAGS_SQL = {"profiles": _profile_sql(), "proposed": f"""
SELECT object_name, column_name, 'PII_TAG' AS tag_name, tag_value, whole >= {TG.WHOLE_RATE} * n_values AS certain FROM profiles
WHERE n_values > 0 AND (whole >= {TG.WHOLE_RATE} * n_values OR part >= {TG.PART_RATE} * n_values)"""}


def all_tables(spark, sf) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in TABLES} | {"customers": D.customers(spark, sf)}


def proposed_tags(spark, sf) -> DataFrame:
    return TG.propose(reduce(DataFrame.unionByName, (TG.profile(df, name) for name, df in all_tables(spark, sf).items())))


@register("g06_g07_tags_from_data", with_("customers", extra=_TAGS_SQL) + "SELECT * FROM proposed")
def g06(spark, sf):
    """Tags proposed for every text column of all tables, as the tag table has taken them."""
    tags, proposed = TG.TagTable(spark, scratch_path(spark, "tags")), proposed_tags(spark, sf).checkpoint()
    tags.set(proposed)
    return tags.references().join(proposed, ["object_name", "column_name", "tag_name", "tag_value"])


@register("g08_tags_through_queries", with_("customers", extra=_TAGS_SQL) + """
SELECT 'orders_by_customer' AS object_name, CASE column_name WHEN 'name' THEN 'customer_name' ELSE column_name END AS column_name,
       tag_name AS tag_name, tag_value AS pii_classification
FROM proposed WHERE object_name = 'customers' AND column_name IN ('name', 'email')
UNION ALL SELECT 'documents_and_pages', column_name, tag_name, tag_value FROM proposed
WHERE object_name = 'documents' AND column_name = 'text' OR object_name = 'pages' AND column_name = 'url'
ORDER BY object_name, column_name""")
def g08(spark, sf):
    """Tags that the columns of derived tables still carry after joins, filters and renames."""
    tags = TG.TagTable(spark, scratch_path(spark, "tags"))
    tags.set(proposed_tags(spark, sf))
    refs = tags.references().checkpoint()
    t = {name: TG.tagged(df, refs.filter(F.col("object_name") == name)) for name, df in all_tables(spark, sf).items() if name in ("customers", "documents", "pages")}
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    sold = (orders.join(t["customers"].filter("is_active"), "customer_id", "left")
            .select("o_orderkey", F.col("name").alias("customer_name"), "email", F.upper("tier").alias("tier")))
    texts = t["documents"].join(t["pages"], t["documents"].doc_id == t["pages"].page_id).select("doc_id", "text", "url")
    return (TG.tags_of(sold, "orders_by_customer").unionByName(TG.tags_of(texts, "documents_and_pages"))
            .withColumnRenamed("tag_value", "pii_classification").orderBy("object_name", "column_name"))
