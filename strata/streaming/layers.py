"""Layers that refresh by themselves, each with its own offset.

Bronze, silver and gold are three streams. Each reads a change log above it (a
folder per change, published by a rename) with a checkpoint of its own:

* bronze reads the raw orders and publishes the orders of each batch;
* silver reads bronze's log and the customer changelog in one query. Changed
  customers are merged into the dimension first; then the batch's orders and
  all orders of changed customers are enriched anew. It publishes its old and
  new rows, signed;
* gold reads silver's log and adds the signed rows.

A layer with a freshness target runs by a trigger of that length. One without
is refreshed when asked for: ``refresh("gold")`` pulls what is pending through
the layers it depends on, and nothing else. ``refreshes`` has a row per batch,
with what it consumed and the measured lag; ``status`` one per layer.

A batch can be cut off anywhere and run again. What silver is about to write
is stored, with the rows it replaces, before the table changes: bronze may go
on in between, so working it out again would give other rows. All layers of a
root run in one application, since plain files give a reader no snapshot; a
lock keeps a batch from reading a table that another one rewrites.
"""

from __future__ import annotations

from threading import RLock
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import When, merge_into
from strata.operators.relational import latest_per_key
from strata.plans import medallion as M
from strata.sources import files
from strata.sources.derived import ORDERS_LATEST
from strata.sources.store import BucketedTable
from strata.streaming.dynamic import GROUP, DynamicTables

# what each layer reads
GRAPH = {"bronze": ("orders",), "silver": ("bronze", "customers"), "gold": ("silver",)}
# The freshness targets of the reference's layers in seconds; None: only when asked for.
TARGETS = {"bronze": 60, "silver": 120, "gold": None}
TOGETHER = "together"


class LayeredTables:
    """The three layers and the customer dimension under ``root``.

    ``customer_schema`` holds customer_id, name, tier, is_active and ``seq``,
    which orders the changes of a customer (the greatest counts).
    """

    def __init__(self, spark: SparkSession, root: str, raw_schema: T.StructType, customer_schema: T.StructType,
                 buckets: int = 16, targets: dict[str, int | None] = TARGETS):
        self.spark, self.root, self.targets = spark, root.rstrip("/"), targets
        self.customer_schema = customer_schema
        empty = spark.createDataFrame([], customer_schema)
        self.tables = DynamicTables(spark, f"{self.root}/tables", empty, raw_schema, buckets)
        self.dim = BucketedTable(spark, f"{self.root}/tables/dim_customers", ["customer_id"], buckets, customer_schema)
        if not self.dim.exists():
            self.dim.write(empty)
        self.schemas = {"orders": raw_schema, "customers": customer_schema,
                        "bronze": self.tables.bronze.schema, "silver": T.StructType([*self.tables.silver.schema.fields, T.StructField("sign", T.IntegerType())])}
        for folder in (*map(self._log_of, self.schemas), f"{self.root}/refreshes"):
            files.make_folder(spark, folder)
        self._lock = RLock()

    # -- change logs -------------------------------------------------------
    def _log_of(self, name: str) -> str:
        return f"{self.root}/log/{name}"

    def _staged(self, name: str, entry: str) -> str:
        return f"{self.root}/staged/{name}/{entry}"

    def land(self, name: str, rows: DataFrame, entry: str) -> None:
        """Add ``rows`` to the log ``orders`` or ``customers`` as one change."""
        rows.select(*self.schemas[name].fieldNames()).write.mode("overwrite").parquet(self._staged(name, entry))
        self._publish(name, entry)

    def _publish(self, name: str, entry: str) -> None:
        files.move(self.spark, self._staged(name, entry), f"{self._log_of(name)}/{entry}")

    def _entry(self, name: str, entry: str) -> DataFrame | None:
        """A published change, or one that is staged whole."""
        for path in (f"{self._log_of(name)}/{entry}", self._staged(name, entry)):
            if files.exists(self.spark, f"{path}/_SUCCESS"):
                return self.spark.read.schema(self.schemas[name]).parquet(path)
        return None

    def _staged_once(self, name: str, entry: str, rows) -> DataFrame:
        """The change as it was first staged; ``rows()`` is asked only if it wasn't."""
        if self._entry(name, entry) is None:
            rows().write.mode("overwrite").parquet(self._staged(name, entry))
        return self._entry(name, entry)

    # -- one batch of each layer ---------------------------------------------
    def _bronze(self, rows: DataFrame, tag: str) -> DataFrame | None:
        """Upsert raw order rows; the batch's orders, as published."""
        latest = self._staged_once("bronze", tag, lambda: latest_per_key(
            rows.select(*self.tables.bronze_cols), ["order_id"], ORDERS_LATEST))
        if latest.isEmpty():
            return None
        self.tables.upsert_bronze(self.tables.bronze.dealt(latest), tag)
        self._publish("bronze", tag)
        return self._entry("bronze", tag)

    def _dimension(self, customers: DataFrame, tag: str) -> DataFrame | None:
        """Merge customer changes into the dimension where they are newer; the changed customers."""
        latest = latest_per_key(customers, ["customer_id"], ["seq"])
        touched = self.dim.touched_partitions(latest)
        if not touched:
            return None
        values = {c: F.col(f"s.{c}") for c in self.customer_schema.fieldNames()}
        newer = F.coalesce(F.col("s.seq") >= F.col("t.seq"), F.col("t.seq").isNull())
        clauses = [When(True, "update", newer, values), When(False, "insert", None, values)]
        self.dim.merge(latest, lambda t, s: merge_into(t, s, ["customer_id"], clauses), batch_id=tag, may_delete=False, touched=touched)
        return latest.select("customer_id")

    def _silver(self, orders: DataFrame | None, customers: DataFrame, tag: str) -> DataFrame | None:
        """Enrich the orders, and those of changed customers; old and new rows, signed, as published."""
        t = self.tables
        if self._entry("silver", tag) is None:
            changed = self._dimension(customers, f"dim-{tag}")
            parts = [] if orders is None else [orders.select("order_id", "order_date")]
            if changed is not None:  # bronze has no index by customer: one scan per batch with changes
                parts.append(t.bronze.read().join(changed, "customer_id", "left_semi").select("order_id", "order_date"))
            if not parts:
                return None
            wanted = t.bronze.dealt(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).dropDuplicates(["order_id"]).checkpoint()
            if wanted.isEmpty():
                return None

            def rows() -> DataFrame:
                ids = wanted.select("order_id")  # dealt as bronze and silver are
                stored = t.bronze.read().join(ids, "order_id", "left_semi").select(*M.BRONZE_COLS)
                before = t.silver.read().join(ids, "order_id", "left_semi")
                return M.silver(stored, self.dim.read()).withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1)))

            self._staged_once("silver", tag, rows)
        new = self._entry("silver", tag).filter(F.col("sign") == 1).drop("sign")
        t.silver.append(t.silver.dealt(new), tag)
        self._publish("silver", tag)
        return self._entry("silver", tag)

    def _gold(self, signed: DataFrame, tag: str) -> None:
        if not self.tables.gold.applied(f"gold-{tag}"):
            delta = signed.filter(F.col("status") != "CANCELLED").select(*GROUP, "order_date", "line_total", "sign")
            self.tables.apply_gold_delta(delta, tag)

    # -- streams ------------------------------------------------------------
    def _read(self, name: str) -> DataFrame:
        """A log as a stream: for each row only the file it is in. The batch reads its files
        itself, as a batch of the rows would read them whole again for each use."""
        rows = self.spark.readStream.schema(self.schemas[name]).option("recursiveFileLookup", True).parquet(self._log_of(name))
        return rows.select(F.lit(name).alias("name"), F.col("_metadata.file_path").alias("file"),
                           F.unix_micros("_metadata.file_modification_time").alias("landed"))

    def _stream(self, names) -> DataFrame:
        stream = self._read(names[0])
        for name in names[1:]:
            stream = stream.unionByName(self._read(name))
        return stream

    def _rows(self, taken: list, name: str) -> DataFrame:
        """The batch's rows of a log."""
        paths = [f"{self._log_of(name)}/{unquote('/'.join(r.file.split('/')[-2:]))}" for r in taken if r.name == name]
        return self.spark.read.schema(self.schemas[name]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[name])

    def _apply(self, layer: str, batch: DataFrame, batch_id: int) -> None:
        tag = f"{layer}-{batch_id}"
        taken = batch.groupBy("name", "file", "landed").agg(F.count(F.lit(1)).alias("rows")).collect()  # a row per file
        with self._lock:
            if layer == "bronze":
                self._bronze(self._rows(taken, "orders"), tag)
            elif layer == "silver":
                self._silver(self._rows(taken, "bronze"), self._rows(taken, "customers"), tag)
            elif layer == "gold":
                self._gold(self._rows(taken, "silver"), tag)
            else:  # all layers in one query
                orders = self._bronze(self._rows(taken, "orders"), tag)
                signed = self._silver(orders, self._rows(taken, "customers"), tag)
                if signed is not None:
                    self._gold(signed, tag)
            self._record(layer, taken, batch_id)

    def _record(self, layer: str, taken: list, batch_id: int) -> None:
        """The refresh as a row: what was consumed, and how old the oldest of it was when the layer had it."""
        entries = sorted({f"{r.name}/{r.file.split('/')[-2]}" for r in taken})
        row = (layer, batch_id, entries, sum(r.rows for r in taken), min((r.landed for r in taken), default=None))
        (self.spark.createDataFrame([row], "layer string, batch_id long, entries array<string>, rows long, oldest long")
         .withColumn("oldest", F.timestamp_micros("oldest")).withColumn("refreshed_at", F.current_timestamp())
         .withColumn("lag_seconds", F.col("refreshed_at").cast("double") - F.col("oldest").cast("double"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/refreshes/{layer}/{batch_id}"))

    def _writer(self, layer: str):
        both = layer == TOGETHER
        if files.exists(self.spark, f"{self.root}/offsets/{TOGETHER}") != both and files.names(self.spark, f"{self.root}/offsets"):
            raise ValueError("the layers of a root are refreshed either together or each by itself")
        return (self._stream(("orders", "customers") if both else GRAPH[layer]).writeStream
                .foreachBatch(lambda batch, batch_id: self._apply(layer, batch, batch_id))
                .option("checkpointLocation", f"{self.root}/offsets/{layer}"))

    def start(self) -> list:
        """Run each layer that has a freshness target by a trigger of that length."""
        return [self._writer(layer).trigger(processingTime=f"{seconds} seconds").start()
                for layer, seconds in self.targets.items() if seconds is not None]

    def refresh(self, layer: str) -> None:
        """Bring ``layer`` up to date: pull what is pending through the layers it depends on."""
        for above in GRAPH[layer]:
            if above in GRAPH:
                self.refresh(above)
        self._writer(layer).trigger(availableNow=True).start().awaitTermination()

    def refresh_together(self) -> None:
        """Drain orders and customer changes through all layers in one query."""
        self._writer(TOGETHER).trigger(availableNow=True).start().awaitTermination()

    # -- what the user reads ---------------------------------------------------
    def paused(self) -> RLock:
        """Keeps started streams from rewriting tables, as long as it is held:
        ``with layers.paused(): layers.read("silver").count()``."""
        return self._lock

    def read(self, layer: str) -> DataFrame:
        if layer == "gold":
            return self.tables.gold_table()
        return self.tables.bronze.read().select(*M.BRONZE_COLS) if layer == "bronze" else self.tables.silver.read()

    def refreshes(self) -> DataFrame:
        """One row per batch: layer, batch_id, entries, rows, oldest, refreshed_at, lag_seconds."""
        return self.spark.read.option("recursiveFileLookup", True).schema(
            "layer string, batch_id long, entries array<string>, rows long, oldest timestamp, refreshed_at timestamp, lag_seconds double"
        ).parquet(f"{self.root}/refreshes")

    def status(self) -> DataFrame:
        """One row per layer: its target, the changes there are and those consumed (its
        offset), how many are pending, its rows, and the lag of its last refresh."""
        there = [(layer, self.targets[layer], sum(len(files.names(self.spark, self._log_of(n))) for n in above)) for layer, above in GRAPH.items()]
        known = self.spark.createDataFrame(there, "layer string, target_seconds int, available int")
        done = self.refreshes().select("layer", "batch_id", "lag_seconds", F.explode("entries").alias("entry")).groupBy("layer").agg(
            F.countDistinct("entry").cast("int").alias("consumed"), F.max_by("lag_seconds", "batch_id").alias("lag_seconds"))
        rows = None
        for layer in GRAPH:
            n = self.read(layer).agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("rows"))
            rows = n if rows is None else rows.unionByName(n)
        consumed = F.coalesce("consumed", F.lit(0))
        return (known.join(done, "layer", "left").join(rows, "layer")
                .select("layer", "target_seconds", "available", consumed.alias("consumed"), (F.col("available") - consumed).alias("pending"), "rows", "lag_seconds"))
