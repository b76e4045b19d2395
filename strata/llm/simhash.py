"""SimHash near-dedup with multi-index hashing.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word
shingles. Fingerprints that differ in at most ``max_distance`` bits link, and
links join documents to components.

Pairs are found with one table per segment left out: the 64 bits are cut into
four segments, and table t holds the fingerprints by the other three. Two
fingerprints at distance 2 either differ in one segment only (equal keys in
that segment's table), or in two; leaving one of the two out, the keys then
differ in exactly one bit of the other. So each fingerprint looks up its key
and the Hamming ball of radius 1 around it, segment by segment, and the
matches' complete distances are verified. A key fixes 48 bits, so a lookup
meets few candidates even inside a dense cluster. Only one of the two
directions of a flip is enumerated (a zero bit is set), which halves the work.

Defined results
* ASCII letters are lower-cased; words are runs of ``[^\\x20\\x09-\\x0D]``.
* Fewer words than the shingle length: the whole sequence is one shingle.
* Null text and text without words have fingerprint zero and link like any other.
* Rows with equal ids are separate rows. A null id is never a component's id
  unless no row of the component has one.
* An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import keep_rows, materialize, row_id, slices
from strata.llm.graph import components

SEED = 42
SEGMENTS = 4
WIDTH = 64 // SEGMENTS


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the shingle hashes, as a signed 64-bit number."""
    words = text.lower().split()  # bytes: ASCII case and ASCII blanks only
    if not words:
        return 0
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    hashes = np.array([h(line[i:j], SEED) for i, j in zip(starts, ends[k - 1:].tolist())], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[i:i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rid, fp`` (signed 64-bit) per row."""
    src = docs.select(F.col(id_col).alias("doc_id"), row_id(F.col(id_col), F.col(text_col)).alias("rid"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["doc_id"], src.schema["rid"], T.StructField("fp", T.LongType(), False)])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                fps = pa.array([fingerprint(t or b"", shingle) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("rid"), fps], names=["doc_id", "rid", "fp"])

    return src.mapInArrow(run, schema)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _key(fp: Column, table: int) -> Column:
    """The fingerprint without the segment that table ``table`` leaves out."""
    mask = ((1 << WIDTH) - 1) << (table * WIDTH)
    return fp.bitwiseAND(F.lit(_signed(~mask & (1 << 64) - 1)))


def near_pairs(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Pairs ``a, b`` of different fingerprints (column ``fp``, distinct)
    within ``max_distance`` bits (0, 1 or 2)."""
    if not 0 <= max_distance <= 2:
        raise ValueError("four segments and balls of radius 1 find distances up to 2")
    fp = F.col("fp")

    def entry(table: int, flip: Column | None = None) -> Column:
        key = _key(fp, table)
        return F.struct(F.lit(table).cast("byte").alias("t"), (key if flip is None else key.bitwiseOR(flip)).alias("key"))

    def ball(table: int) -> Column:
        """The key itself, and with one zero bit set in a segment before the one left out."""
        flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)).cast("long") for i in range(table * WIDTH)))
        return F.transform(F.filter(flips, lambda m: m.bitwiseAND(fp) == 0), lambda m: entry(table, m))

    tables = fps.select(fp.alias("b"), F.explode(F.array(*map(entry, range(SEGMENTS)))).alias("k"))
    probes = fps.select(fp.alias("a"), F.explode(F.flatten(F.array(*map(ball, range(SEGMENTS))))).alias("k"))
    found = probes.select("a", "k.t", "k.key").join(tables.select("b", "k.t", "k.key"), ["t", "key"])
    return (found.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def near_dedup(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, rid``."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    # copies meet here, pre-aggregated: from now on a fingerprint is one row
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = materialize(components(near_pairs(classes.select("fp"), max_distance)), "roots")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids")
    named = materialize(rooted.join(least, "root").select("fp", "root", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "rid", F.col("root").alias("component_root"))


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with its columns as they are: the one with
    the smallest id (of repeated ids, the smallest row identity)."""
    found = near_dedup(docs, shingle, max_distance, id_col, text_col)
    first = found.groupBy("component_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("f"))
    return keep_rows(docs, first.select(F.col("f.rid").alias("rid")), id_col, text_col)
