"""CSV file formats, bulk load with rejects, load history, landing listing
(S01-S04, S06).

The reader takes every field as a string plus a corrupt-record column, so
rows with the wrong number of fields are flagged by the parser itself, and
every other row keeps its raw tokens; typing happens afterwards with
``try_cast`` so one bad value rejects its row without failing the load.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import files

CORRUPT = "_corrupt_record"
RAW = "_raw_record"
FILE = "_file"


@dataclass
class CsvFormat:
    """``CREATE FILE FORMAT ... TYPE='CSV'``."""

    delimiter: str = ","
    skip_header: bool = True
    null_if: tuple[str, ...] = ("NULL", "null", "")
    empty_field_as_null: bool = True
    trim_space: bool = True
    quote: str = '"'
    escape: str = '"'
    options: dict[str, str] = field(default_factory=dict)


def read_tokens(spark: SparkSession, path: str | list[str], columns: list[str], fmt: CsvFormat) -> DataFrame:
    """Raw string tokens per row with file name and a corrupt-record column."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField(CORRUPT, T.StringType())])
    r = (spark.read.format("csv").schema(schema)
         .option("header", str(fmt.skip_header).lower())
         .option("sep", fmt.delimiter).option("quote", fmt.quote).option("escape", fmt.escape)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("ignoreLeadingWhiteSpace", str(fmt.trim_space).lower())
         .option("ignoreTrailingWhiteSpace", str(fmt.trim_space).lower())
         .option("recursiveFileLookup", "true"))
    for k, v in fmt.options.items():
        r = r.option(k, v)
    df = r.load(path).withColumn(FILE, F.col("_metadata.file_path"))
    # several null tokens: the reader's nullValue takes only one
    nulls = [*fmt.null_if, *([""] if fmt.empty_field_as_null else [])]
    out = [F.when(F.col(c).isin(nulls), None).otherwise(F.col(c)).alias(c) for c in columns]
    # the record as it was read, before null tokens are dropped
    raw = F.coalesce(F.col(CORRUPT), F.concat_ws(fmt.delimiter, *(F.coalesce(F.col(c), F.lit("")) for c in columns)))
    return df.select(*out, CORRUPT, FILE, raw.alias(RAW))


def _cast_errors(schema: T.StructType) -> tuple[list[Column], Column]:
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    err = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        err = F.when(bad, F.lit(f"cannot convert column {f.name} to {f.dataType.simpleString()}")).otherwise(err)
    return typed, err


def _tagged(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: CsvFormat) -> DataFrame:
    """Every row of the files: typed columns, the error if it is rejected, file and raw record."""
    typed, err = _cast_errors(schema)
    error = F.when(F.col(CORRUPT).isNotNull(), F.lit("number of columns does not match")).otherwise(err)
    return read_tokens(spark, path, schema.fieldNames(), fmt).select(*typed, error.alias("_error"), FILE, RAW)


def _split(tagged: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    good = tagged.filter(F.col("_error").isNull()).select(*schema.fieldNames())
    rejects = tagged.filter(F.col("_error").isNotNull()).select(
        F.col(FILE).alias("file"), F.col("_error").alias("error"), F.col(RAW).alias("raw_record"))
    return good, rejects


def copy_into(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: CsvFormat | None = None,
              on_error: str = "CONTINUE") -> tuple[DataFrame, DataFrame]:
    """``COPY INTO t FROM path ON_ERROR='CONTINUE'`` (S02): ``(good, rejects)``.

    A row is rejected when its field count differs or any non-null token
    fails its cast. ``good`` has ``schema``; ``rejects`` has file, error and
    the raw record. Each frame that is used parses the files once;
    ``copy_into_table`` parses them once for all.
    """
    if on_error.upper() not in ("CONTINUE", "ABORT_STATEMENT"):
        raise ValueError(f"on_error {on_error!r} is not covered")
    tagged = _tagged(spark, path, schema, fmt or CsvFormat())
    if on_error.upper() == "ABORT_STATEMENT":
        first = tagged.filter(F.col("_error").isNotNull()).select("_error").limit(1).collect()
        if first:
            raise ValueError(first[0][0])
    return _split(tagged, schema)


def load_history(spark: SparkSession, path: str | list[str], schema: T.StructType, table_name: str,
                 fmt: CsvFormat | None = None, load_time: Column | None = None) -> DataFrame:
    """One load record per file (S03): rows parsed/loaded, errors, first error, status.

    One aggregate grouped by file name; the number of groups is the number
    of files, never the number of rows.
    """
    return _history(_tagged(spark, path, schema, fmt or CsvFormat()), table_name, load_time)


def _history(tagged: DataFrame, table_name: str, load_time: Column | None) -> DataFrame:
    h = tagged.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count(F.when(F.col("_error").isNull(), 1)).alias("rows_loaded"),
        F.count("_error").alias("errors_seen"),
        F.min("_error").alias("first_error"))
    status = (F.when(F.col("errors_seen") == 0, "LOADED")
              .when(F.col("rows_loaded") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    return h.select(
        F.lit(table_name.upper()).alias("table_name"),
        F.col(FILE).alias("file_name"), "rows_parsed", "rows_loaded", "errors_seen", "first_error",
        status.alias("status"),
        (load_time if load_time is not None else F.current_timestamp()).alias("last_load_time"))


def latest_loads(history: DataFrame, table_name: str, n: int = 10) -> DataFrame:
    """``... WHERE table_name = t ORDER BY last_load_time DESC LIMIT n`` (S03);
    SQL's default puts NULLs first in a descending sort (Q12)."""
    return (history.filter(F.col("table_name") == table_name.upper())
            .orderBy(F.col("last_load_time").desc_nulls_first(), F.col("file_name").desc_nulls_first()).limit(n))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``LIST @stage`` (S04): name, size and last-modified time; content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).load(path)
            .select(F.col("path").alias("name"), F.col("length").alias("size"),
                    F.col("modificationTime").alias("last_modified")))


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``dbt seed`` (S06): typed CSV with header; quoted commas and spaces kept."""
    return (spark.read.format("csv").schema(schema).option("header", "true")
            .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .load(path))


def copy_into_table(spark: SparkSession, landing: str, schema: T.StructType, table_path: str, history_path: str,
                    table_name: str, fmt: CsvFormat | None = None, force: bool = False,
                    load_time: Column | None = None) -> DataFrame:
    """``COPY INTO table FROM landing``, run repeatedly: files already in the
    load history (same path, size and modification time) are skipped unless
    ``force``, so replaying a load does not duplicate rows (S02/S03).

    A load writes its rows to ``table_path/load_id=...``, its rejects to
    ``table_path_rejects/load_id=...`` and one record per file to
    ``history_path``; the history is the commit. The files of a load are
    listed in ``history_path_pending`` first: a run after one that broke off
    takes up the same list under the same id and writes over what is there,
    so no row is loaded twice or lost. The files are parsed once, into
    ``table_path_staged``, from which rows, rejects and history come.
    Returns this run's history records.

    Listing is metadata only (``binaryFile`` with the content column pruned);
    the new-file list goes to the reader like any file source's listing.
    """
    table, history = table_path.rstrip("/"), history_path.rstrip("/")
    seen = files.read_if_written(spark, history)
    pending = files.read_if_written(spark, f"{history}_pending")
    if pending is not None and seen is not None:
        pending = pending.join(seen.select("load_id"), "load_id", "left_anti")
    if pending is None or pending.isEmpty():  # else a load broke off: its files again
        new = list_files(spark, landing).select(F.col("name").alias("file_name"), "size", "last_modified")
        if seen is not None and not force:
            new = new.join(seen.select("file_name", "size", "last_modified"), ["file_name", "size", "last_modified"], "left_anti")
        # a name that never reads as a number, for it becomes a partition value
        new.withColumn("load_id", F.lit(f"load-{uuid.uuid4().hex}")).write.mode("overwrite").parquet(f"{history}_pending")
    plan = spark.read.parquet(f"{history}_pending")
    listed = plan.select("file_name", "load_id").collect()
    if not listed:
        return spark.createDataFrame([], _history_schema())
    load_id, staged = listed[0].load_id, f"{table}_staged/{listed[0].load_id}"
    _tagged(spark, [r.file_name for r in listed], schema, fmt or CsvFormat()).write.mode("overwrite").parquet(staged)
    tagged = spark.read.parquet(staged)
    good, rejects = _split(tagged, schema)
    good.write.mode("overwrite").parquet(f"{table}/load_id={load_id}")
    rejects.write.mode("overwrite").parquet(f"{table}_rejects/load_id={load_id}")
    # one file, so that it is there whole or not at all (one small row per loaded file)
    loaded = _history(tagged, table_name, load_time).drop("table_name", "last_load_time")
    (plan.join(loaded, "file_name", "left")  # a file without rows is loaded too
     .fillna(0, ["rows_parsed", "rows_loaded", "errors_seen"]).fillna("LOADED", ["status"])
     .withColumn("table_name", F.lit(table_name.upper()))
     .withColumn("last_load_time", (load_time if load_time is not None else F.current_timestamp()).cast("timestamp"))
     .select(*_history_schema().fieldNames()).coalesce(1).write.mode("append").parquet(history))
    files.delete(spark, staged)
    return spark.read.parquet(history).filter(F.col("load_id") == load_id)


def _history_schema() -> T.StructType:
    return T.StructType([
        T.StructField("file_name", T.StringType()), T.StructField("table_name", T.StringType()),
        T.StructField("rows_parsed", T.LongType()), T.StructField("rows_loaded", T.LongType()),
        T.StructField("errors_seen", T.LongType()), T.StructField("first_error", T.StringType()),
        T.StructField("status", T.StringType()), T.StructField("last_load_time", T.TimestampType()),
        T.StructField("size", T.LongType()), T.StructField("last_modified", T.TimestampType()),
        T.StructField("load_id", T.StringType()),
    ])
