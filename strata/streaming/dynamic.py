"""Dynamic tables as Structured Streaming.

A stream over the raw orders folder drives one ``foreachBatch`` per
micro-batch that refreshes bronze, silver and gold incrementally:

* bronze: the batch is collapsed to its latest row per order; the rows newer
  than the stored ones are added (batches need not arrive in event order);
* silver: re-enriched for the orders that changed in bronze;
* gold: maintained exactly from deltas. Silver holds one row per order, so
  COUNT(DISTINCT order_id) of a group is its row count and, like the sums,
  changes by +1/-1 rows of the orders that entered or left the group. MAX
  is not invertible, so counts per (group, date) keep the latest date exact
  under retractions. Groups whose count drops to zero disappear from the
  published table.

Every table only appends what a batch changes and merges when read
(``strata.sources.change_table``): a batch writes in proportion to itself, and
looks up stored rows bucket by bucket, without moving them.

Gold runs inside silver's batch (it refreshes whenever its input does). Every table
write is keyed by the batch id, so a replayed batch is skipped (C05), and a
change of the customer dimension refreshes silver and gold for the affected
customers' orders (C12).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.cdc import change_feed
from strata.operators.relational import latest_per_key
from strata.plans import medallion as M
from strata.sources import files
from strata.sources.change_table import CHANGE, ChangeTable
from strata.sources.derived import ORDERS_LATEST

GROUP = ("customer_name", "customer_tier")
SUM, CNT = "_sum_line_total", "_count_line_total"


def _desc_nulls_first_key():
    """Comparable key of the batch dedup order: NULL ranks above any value,
    as in ``ORDER BY ... DESC`` with SQL's NULLS FIRST (same as latest_per_key)."""
    return F.struct(*(x for c in ORDERS_LATEST for x in (F.col(c).isNull(), F.col(c))))


def _last_change(silver: DataFrame) -> DataFrame:
    """The rows of each order that came with its last change: more than one if its customer is there twice."""
    w = Window.partitionBy("order_id").orderBy(F.desc(CHANGE))
    return silver.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank", CHANGE)


def _summed_dates(dates: DataFrame) -> DataFrame:
    return dates.groupBy(*GROUP, "order_date").agg(*(F.sum(c).cast(t).alias(c) for c, t in (("n", "long"), (SUM, "decimal(38,2)"), (CNT, "long"))))


def _summed_groups(gold: DataFrame) -> DataFrame:
    """Signed group rows added up; the last date is that of the group's last change."""
    total = gold.groupBy(*GROUP).agg(
        F.sum("total_orders").cast("long").alias("total_orders"), F.max_by("last_order_date", CHANGE).alias("last_order_date"),
        F.sum(SUM).cast("decimal(38,2)").alias(SUM), F.sum(CNT).cast("long").alias(CNT))
    some, value = F.col(CNT) > 0, F.col(SUM).cast("double")
    return total.select(*GROUP, "total_orders", F.when(some, value).alias("lifetime_value"),
                        F.when(some, value / F.col(CNT)).alias("avg_order_value"), "last_order_date", SUM, CNT)


class DynamicTables:
    """Bronze/silver/gold tables under ``root``, refreshed from a raw-orders stream."""

    def __init__(self, spark: SparkSession, root: str, dim_customers: DataFrame, raw_schema,
                 buckets: int = 16, period_grain: str | None = None):
        """``buckets``: hash buckets per table (size them so a bucket is a few
        hundred MB). ``period_grain`` ('month', 'year', ...): look up stored
        rows of the batch's periods only (an order must keep its date; files
        of other periods are skipped by their statistics). Off by default
        because the test streams spread every batch over all years."""
        self.spark, self.root = spark, root.rstrip("/")
        self.dim = dim_customers
        self.raw_schema = raw_schema
        raw0 = spark.createDataFrame([], raw_schema)
        keep = list(M.BRONZE_COLS) + [c for c in ORDERS_LATEST if c not in M.BRONZE_COLS]
        self.bronze_cols = keep
        b_schema = raw0.select(*keep).schema
        s_schema = M.silver(M.bronze(raw0), dim_customers).schema
        g_schema = M.gold(M.silver(M.bronze(raw0), dim_customers)).schema
        self.gold_columns = g_schema.fieldNames()
        # gold rows carry the exact decimal sum and the non-null count behind the averages
        # changes of gold are signed: order count, exact decimal sum and non-null count per group (and date)
        sums = [T.StructField(SUM, T.DecimalType(38, 2)), T.StructField(CNT, T.LongType())]
        gs_schema = T.StructType([*(g_schema[c] for c in (*GROUP, "total_orders", "last_order_date")), *sums])
        d_schema = T.StructType([*(s_schema[c] for c in (*GROUP, "order_date")), T.StructField("n", T.LongType()), *sums])
        self.period = period_grain

        def table(name: str, keys: Sequence[str], schema: T.StructType, merged) -> ChangeTable:
            return ChangeTable(spark, f"{self.root}/{name}", keys, buckets, schema, merged)

        self.bronze = table("bronze_orders", ["order_id"], b_schema, lambda rows: latest_per_key(rows.drop(CHANGE), ["order_id"], ORDERS_LATEST))
        self.silver = table("silver_orders_enriched", ["order_id"], s_schema, _last_change)
        self.gold = table("gold_customer_metrics", GROUP, gs_schema, _summed_groups)
        # bucketed by group (not date), so one group's dates sit in one bucket
        self.dates = table("_gold_dates", GROUP, d_schema, _summed_dates)

    def gold_table(self) -> DataFrame:
        """The published gold table: non-empty groups, without bookkeeping columns."""
        return self.gold.read().filter(F.col("total_orders") > 0).select(*self.gold_columns)

    # -- one micro-batch ----------------------------------------------------
    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch of raw order rows to all three layers."""
        tag = f"orders-{batch_id}"
        # dealt before the dedup, which then needs no shuffle of its own
        self.upsert_bronze(latest_per_key(self.bronze.dealt(batch.select(*self.bronze_cols)), ["order_id"], ORDERS_LATEST), tag)
        self._refresh_orders(lambda: self.bronze.change(tag), tag)

    def upsert_bronze(self, latest: DataFrame, tag: str) -> None:
        """Add the rows of ``latest`` (one per order, dealt in bronze's buckets) that are newer than the stored ones."""
        if self.bronze.applied(tag):
            return
        stored = self._of_periods(self.bronze.changes(), latest)
        stored = stored.groupBy("order_id").agg(F.max(_desc_nulls_first_key()).alias("_stored"))
        newer = F.col("_stored").isNull() | (_desc_nulls_first_key() > F.col("_stored"))
        self.bronze.append(latest.join(stored, "order_id", "left").filter(newer), tag)

    def _of_periods(self, rows: DataFrame, orders: DataFrame) -> DataFrame:
        """With a period grain: only the stored rows from the first to the last period of ``orders``."""
        if not self.period:
            return rows
        first, last = orders.agg(F.trunc(F.min("order_date"), self.period), F.max("order_date")).first()
        date = F.col("order_date")
        return rows.filter(date.isNull() | ((date >= F.lit(first)) & (date <= F.lit(last))))

    def _refresh_orders(self, bronze_rows, tag: str, dim: DataFrame | None = None) -> None:
        """Re-enrich the orders of ``bronze_rows()`` into silver and apply the gold deltas.

        Silver keeps the rows it replaces as earlier changes, so a replay
        finds the same old rows: nothing has to be stored beside it.
        """
        if self.gold.applied(f"gold-{tag}"):
            return
        if not self.silver.applied(f"silver-{tag}"):
            # an order without an id has no row of its own to replace: it stays in bronze
            orders = bronze_rows().select(*M.BRONZE_COLS).filter(F.col("order_id").isNotNull())
            self.silver.append(self.silver.dealt(M.silver(orders, self.dim if dim is None else dim)), f"silver-{tag}")
        self.apply_gold_delta(self._signed(f"silver-{tag}"), tag)

    def _signed(self, batch_id: str) -> DataFrame:
        """What a change of silver adds to gold: its rows with +1, those they replaced with -1."""
        w = Window.partitionBy("order_id").orderBy(F.desc(CHANGE))
        number = self.silver.number(batch_id)
        rows = self._of_periods(self.silver.changes(), self.silver.change(batch_id)).filter(F.col(CHANGE) <= number)
        ranked = rows.select("order_id", *GROUP, "order_date", "status", "line_total", CHANGE).withColumn("_rank", F.dense_rank().over(w))
        ranked = ranked.withColumn("_last", F.first(CHANGE).over(w)).filter((F.col("_rank") <= 2) & (F.col("_last") == number))
        # gold only counts non-cancelled orders; NULL status is dropped too
        return ranked.filter(F.col("status") != "CANCELLED").select(
            *GROUP, "order_date", "line_total", F.when(F.col("_rank") == 1, 1).otherwise(-1).alias("sign"))

    def apply_gold_delta(self, delta: DataFrame, tag: str) -> None:
        keys = list(GROUP)
        # 1) per (group, date): signed order count, exact sum and non-null count. Added up before the
        # rows are dealt by group, as all orders without a customer are one group
        if not self.dates.applied(f"dates-{tag}"):
            dd = delta.groupBy(*keys, "order_date").agg(
                F.sum("sign").cast("long").alias("n"),
                F.sum(F.col("sign") * F.col("line_total")).cast("decimal(38,2)").alias(SUM),
                F.sum(F.when(F.col("line_total").isNotNull(), F.col("sign")).otherwise(0)).cast("long").alias(CNT))
            self.dates.append(self.dates.dealt(dd), f"dates-{tag}")
        # 2) per group of this change: what it adds, and the exact MAX(order_date) under retractions
        now = F.col(CHANGE) == self.dates.number(f"dates-{tag}")
        per_date = self.dates.changes().groupBy(*keys, "order_date").agg(
            F.sum("n").alias("_n"), F.max(now).alias("_now"), *(F.sum(F.when(now, F.col(c))).alias(c) for c in ("n", SUM, CNT)))
        groups = per_date.groupBy(*keys).agg(
            F.sum("n").cast("long").alias("total_orders"), F.max(F.when(F.col("_n") > 0, F.col("order_date"))).alias("last_order_date"),
            F.sum(SUM).cast("decimal(38,2)").alias(SUM), F.sum(CNT).cast("long").alias(CNT), F.max("_now").alias("_now"))
        self.gold.append(groups.filter("_now"), f"gold-{tag}")  # emptied groups read as zero; gold_table() hides them
        for table in (self.bronze, self.silver, self.dates, self.gold):
            table.compact()

    # -- dimension changes ----------------------------------------------------
    def on_dimension_change(self, new_dim: DataFrame, change_id: str) -> None:
        """The customer dimension changed; refresh the affected orders."""
        cols = ["customer_id", "name", "tier", "is_active"]
        # the changed customers are kept under the change's id: a retry, also by a new process, refreshes the same ones
        path = f"{self.root}/_dim/{change_id}"
        if not files.written(self.spark, path):
            feed = change_feed(self.dim.select(*cols), new_dim.select(*cols), ["customer_id"])
            feed.select("customer_id").distinct().write.mode("overwrite").parquet(path)
        changed = self.spark.read.parquet(path)
        # no index by customer: a dimension change scans bronze once for its orders
        self._refresh_orders(lambda: self.bronze.read().join(changed, "customer_id", "left_semi"), f"dim-{change_id}", dim=new_dim)
        self.dim = new_dim

    # -- the stream --------------------------------------------------------
    def run(self, source_dir: str, checkpoint: str, available_now: bool = True,
            freshness: str = "1 minute", max_files_per_trigger: int | None = None):
        """Start the refresh stream. ``available_now`` drains what is there and
        stops (tests, scheduled runs); otherwise a processing-time trigger of
        ``freshness`` is the table's freshness target (C09)."""
        reader = self.spark.readStream.schema(self.raw_schema).option("recursiveFileLookup", True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = reader.parquet(source_dir)
        w = (stream.writeStream.foreachBatch(lambda df, bid: self.refresh(df, bid))
             .option("checkpointLocation", checkpoint))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=freshness)
        q = w.start()
        if available_now:
            q.awaitTermination()
        return q
