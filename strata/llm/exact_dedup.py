"""Exact dedup against a persistent digest index.

The index is a parquet table bucketed and sorted by digest. A batch is
grouped by digest, sort-merge anti-joined with the index, and the digests
that are new are appended. Only DataFrame operations are used.

Defined results
* Text is compared without the characters of ``[\\x20\\x09-\\x0D]``; null is empty.
* Of equal texts in one batch the longest original (code points) stays, then
  the smallest id. A text that an earlier batch brought keeps that batch's id.
* Rows that repeat an id and a text are one document: all carry ``kept``.
* Ids are of any type that can be ordered. A null id sorts after all others, and stays only if no other row has one.
* Adding a batch again changes nothing and gives the same decisions.
* An empty batch gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import keep_rows, materialize, row_id
from strata.session import scratch_path
from strata.sources import files

BLANKS = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text without blanks."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "").cast("binary"), 256)


class DigestIndex:
    """The digests seen so far and the id of the document that stays for each.

    ``path`` names the table's folder, on storage that all executors share; a
    later session that gives the same path goes on with it. ``buckets``
    (default: the session's shuffle partitions) should make a bucket a few
    hundred MB at the size the index will reach. It and the id type are stored
    in the folder: an index keeps them, whatever a later session's settings are.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int | None = None) -> None:
        self.spark, self.path = spark, path
        self.name = "strata_digests_" + hashlib.md5(path.encode()).hexdigest()[:12]
        stored = [x.split("-", 1) for x in files.names(spark, f"{path}/_layout")]
        if stored and stored[0][1] != id_type:
            raise ValueError(f"the index holds ids of type {stored[0][1]}")
        n = int(stored[0][0]) if stored else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets, self.layout = n, f"{path}/_layout/{n}-{id_type}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {id_type}, n_chars INT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {n} BUCKETS LOCATION '{path}'")
        files.touch(spark, self.layout)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame) -> DataFrame:
        """Append the digests of ``groups`` (digest, keep_id, n_chars, ...;
        one row per digest) that are new, and return ``groups`` with the
        index's ``keep_id``."""
        new = groups.hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        new.select("digest", "keep_id", "n_chars").write.insertInto(self.name)
        return (groups.drop("keep_id", "n_chars").hint("merge")
                .join(self.read().select("digest", "keep_id"), "digest"))

    def compact(self) -> None:
        """Write each bucket as one sorted file again, as appends add files. The
        rows are copied first; if the rewrite breaks off, write them again from that copy."""
        rows = materialize(self.read(), "digest-copy")
        rows.repartition(self.buckets, "digest").write.insertInto(self.name, overwrite=True)
        files.touch(self.spark, self.layout)


def dedup(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add the documents to the index. One row per document: ``doc_id,
    keep_id, group_size, kept, text_sha256, n_chars, rid``."""
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_chars"),
        row_id(F.col(id_col), F.col(text_col)).alias("rid")), "digests")
    # the partial aggregate leaves one row per digest and task, however large a group is
    best = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    groups = materialize(
        rows.groupBy("digest").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.shorter")).alias("n_chars"), "group_size"),
        "digest-groups")
    # written, so that both sides of the last join are shuffled and a hot digest can be split
    decided = materialize(index.add(groups), "digest-decisions")
    return rows.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"), "n_chars", "rid")


def new_index(docs: DataFrame, id_col: str = "doc_id") -> DigestIndex:
    """An empty index in the shared folder, for one run."""
    spark = docs.sparkSession
    return DigestIndex(spark, scratch_path(spark, "digest-index"), docs.schema[id_col].dataType.simpleString())


def keep_first(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they are."""
    decisions = dedup(docs, index, id_col, text_col)
    # a kept row's identity, not its id alone: an id may come with several texts
    best = decisions.where("kept").groupBy("text_sha256").agg(F.max(F.struct("n_chars", "rid")).alias("b"))
    return keep_rows(docs, best.select(F.col("b.rid").alias("rid")), id_col, text_col)
