"""Approximate vector search with random-projection hash tables.

Each of ``tables`` hash tables cuts space by ``bits`` random planes; a vector's
code is the side of each plane that it lies on. A question looks into its own
bucket of every table and into those whose code differs where it lies nearest
to a plane (``probes``), and the documents met are ranked by their exact cosine.
A question that meets fewer than ``k`` documents is searched exactly instead.

The probes a recall takes grow with the documents. They are fitted: up to
``SAMPLE`` questions are searched exactly, and the fewest probes are taken with
which the tables meet ``WANTED`` of what those found. If none do, all questions
are searched exactly. Every question is answered from the whole index.

Equal vectors share all buckets; only the ``k`` smallest ids of each can be
among the best, so only those are indexed and a heap of copies fills no bucket.
"""

from __future__ import annotations

import math
from copy import copy
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators import block_search
from strata.operators.block_search import Vectors
from strata.operators.retrieval import rank_top_k
from strata.session import scratch_path

TABLES, ROWS_PER_BUCKET = 16, 8
SAMPLE, WANTED = 64, 0.95  # fixed values: questions the probes are fitted on, and the part of their best to be met
ROWS_AT_ONCE = 64  # bounds the arrays of codes in a task


def _planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables * bits, dim))


def flips(bits: int) -> list[tuple[int, ...]]:
    """All ways to change up to three of a code's bits, by position in the order of distance."""
    return [f for n in range(min(3, bits) + 1) for f in combinations(range(bits), n)]


def codes(rows: DataFrame, id_col: str, tables: int, bits: int, probes: int = 1, seed: int = 1) -> DataFrame:
    """``id_col, table, code, probe`` of vectors ``v``, with the ``probes`` codes (numbered from 1) that
    cost least: the sum of the distances to the planes on whose other side they lie."""
    def run(batches):
        changes = flips(bits) if probes > 1 else [()]
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                values, ends = block_search._flat(pa.chunked_array([part.column("v")]))
                m = values.reshape(len(ends) - 1, -1)
                side = (m @ _planes(m.shape[1], tables, bits, seed).T).reshape(len(m), tables, bits)
                order = np.argsort(np.abs(side), axis=2)
                near = np.take_along_axis(np.abs(side), order, axis=2)
                own = ((side > 0) << np.arange(bits)).sum(axis=2)
                cost = np.stack([sum((near[:, :, i] for i in f), np.zeros(near.shape[:2])) for f in changes], axis=2)
                found = np.stack([own ^ sum((1 << order[:, :, i] for i in f), np.zeros_like(own)) for f in changes], axis=2)
                taken = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]
                found = np.take_along_axis(found, taken, axis=2)
                n = found.shape[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(id_col).to_numpy(), tables * n)), pa.array(np.tile(np.repeat(np.arange(tables), n), len(m))),
                     pa.array(found.ravel()), pa.array(np.tile(np.arange(1, n + 1), len(m) * tables))],
                    names=[id_col, "table", "code", "probe"])

    return rows.select(id_col, "v").mapInArrow(run, f"{id_col} long, table long, code long, probe long")


class ProjectionTables:
    """Hash tables over the document vectors, written once; every vector is indexed."""

    def __init__(self, docs: DataFrame, k: int = 3, id_col: str = "doc_id", vec_col: str = "embedding", tables: int = TABLES,
                 rows_per_bucket: int = ROWS_PER_BUCKET, seed: int = 1) -> None:
        spark = docs.sparkSession
        self.docs, self.k, self.tables, self.seed = docs.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("embedding")), k, tables, seed
        rows = Vectors(docs, docs, id_col, vec_col, id_col, vec_col).docs
        first = Window.partitionBy("v").orderBy("doc")
        few = rows.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= k).drop("i")
        path = scratch_path(spark, "projection-tables")
        few.write.parquet(f"{path}/vectors")
        self.vectors = spark.read.schema(few.schema).parquet(f"{path}/vectors")
        self.bits = max(1, round(math.log2(max(2, self.vectors.count() / rows_per_bucket))))
        index = codes(self.vectors, "doc", tables, self.bits, seed=seed).drop("probe")
        index.write.parquet(f"{path}/codes")
        self.index = spark.read.schema(index.schema).parquet(f"{path}/codes")

    def fitted_probes(self, vectors: Vectors, sample: int = SAMPLE, wanted: float = WANTED) -> int | None:
        """The fewest probes with which the tables meet ``wanted`` of the exact best of ``sample`` questions; None if none do."""
        asked = copy(vectors)
        asked.questions = vectors.questions.orderBy(F.xxhash64("q"), "q").limit(sample).checkpoint(eager=True)
        best = rank_top_k(block_search.top_of(block_search.search(asked, self.k)), "q", "doc", self.k).select("q", "doc").checkpoint(eager=True)
        own = self.index.join(best, "doc")
        met = (codes(asked.questions, "q", self.tables, self.bits, len(flips(self.bits)), self.seed).join(own, ["q", "table", "code"])
               .groupBy("q", "doc").agg(F.min("probe").alias("probe")).groupBy("probe").agg(F.count(F.lit(1)).alias("n")))
        pairs, so_far = best.count(), 0
        for r in met.orderBy("probe").collect():  # at most a row per probe
            so_far += r.n
            if so_far >= wanted * pairs:
                return r.probe
        return None

    def candidates(self, questions: DataFrame, probes: int) -> DataFrame:
        """``q, doc``: what each question (q, v) meets in its buckets."""
        asked = codes(questions, "q", self.tables, self.bits, probes, self.seed)
        return asked.join(self.index, ["table", "code"]).select("q", "doc").distinct()

    def top_k(self, queries: DataFrame, q_id: str = "q_id", q_vec: str = "embedding", probes: int | None = None) -> DataFrame:
        """``q_id, doc_id, score, rank``: the best that the tables find, exactly ranked; fitted ``probes`` if None."""
        vectors = Vectors(self.docs, queries, q_id=q_id, q_vec=q_vec)
        vectors.docs = self.vectors
        if probes is None and (probes := self.fitted_probes(vectors)) is None:
            return rank_top_k(block_search.top_of(block_search.search(vectors, self.k)), "q", "doc", self.k).withColumnsRenamed({"q": q_id, "doc": "doc_id"})
        scores = block_search.scores_of(vectors, self.candidates(vectors.questions, probes)).checkpoint(eager=True)
        met = scores.groupBy("q").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= self.k)
        vectors.questions = vectors.questions.join(met, "q", "left_anti")  # these are searched exactly
        rest = block_search.top_of(block_search.search(vectors, self.k))
        found = scores.join(met.select("q"), "q", "left_semi").unionByName(rest)
        return rank_top_k(found, "q", "doc", self.k).withColumnsRenamed({"q": q_id, "doc": "doc_id"})


def recall(found: DataFrame, exact: DataFrame, q_id: str = "q_id", id_col: str = "doc_id") -> DataFrame:
    """One row: how many of the ``exact`` (question, document) pairs are ``found``."""
    hit = exact.select(q_id, id_col).join(found.select(q_id, id_col, F.lit(1).alias("hit")), [q_id, id_col], "left")
    return hit.agg(F.countDistinct(q_id).alias("questions"), F.count(F.lit(1)).alias("exact_pairs"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))
