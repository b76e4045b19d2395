"""Exact top-k inner-product search with a ball tree per shard.

Vectors are dealt to shards by a hash of their id. In each shard a ball tree
is built, and blocks of queries walk it branch and bound: nodes in the order
of their inner-product upper bound (centre times query, plus radius times the
query's length), skipping a node for every query whose k-th score the bound
cannot reach. The k-th score is shared: a first pass over one shard gives each
query a k-th score, and the pass over all other shards starts from it, so most
nodes fall away and only rows that can still matter leave a shard.

Defined results
* Components are integers ``floor(scale * x)``; scores are exact integers.
* Vectors that are null, or hold a null or non-finite component, take no part.
* Only vectors of equal length are compared; vectors without components score 0.
* Fewer than k other rows: all of them. Ties go to the smaller id. Rows that
  repeat an id are separate candidates; none is a candidate of its own id.
* No queries or no candidates give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import blocks_for, materialize

LEAF = 128


def quantise(vector: Column, scale: int = 256) -> Column:
    """Integer components, or null if the vector takes no part."""
    good = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


class BallTree:
    """Vectors of one length, as nodes of nested index ranges."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order, self.nodes, todo = np.arange(len(ids)), [], [(0, len(ids), -1)]
        points = vectors.astype(np.float64)
        while todo:
            start, end, parent = todo.pop()
            own = points[order[start:end]]
            centre = own.mean(axis=0)
            radius = np.sqrt(((own - centre) ** 2).sum(axis=1).max()) if end > start else 0.0
            at = len(self.nodes)
            self.nodes.append([centre, radius, start, end, []])
            if parent >= 0:
                self.nodes[parent][4].append(at)
            if end - start > LEAF and radius > 0:
                spread = own.max(axis=0) - own.min(axis=0)
                half = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(own[:, spread.argmax()], half)]
                todo += [(start, start + half, at), (start + half, end, at)]
        self.ids, self.vectors = ids[order], vectors[order]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query position, id, score`` of the best k candidates of each
        query with a score of at least its ``floor``."""
        q, length = queries.astype(np.float64), np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        none = np.iinfo(np.int64).min
        best = np.full((len(q), k), none, dtype=np.int64)
        found = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
        kth = floor.copy()  # a candidate below it cannot matter
        exact = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, q.shape[1]) < 2**53

        def bound(node: int, who: np.ndarray) -> np.ndarray:
            centre, radius = self.nodes[node][:2]
            top = q[who] @ centre + radius * length[who]
            return top + np.abs(top) * 1e-9 + 1  # rounding never hides a candidate

        everyone = np.arange(len(q))
        heap = [(-bound(0, everyone).max(initial=0), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            who = everyone[bound(node, everyone) >= kth]
            if not len(who):
                continue
            _, _, start, end, children = self.nodes[node]
            if children:
                for c in children:
                    heapq.heappush(heap, (-bound(c, who).max(), c))
                continue
            for at in range(start, end, 4096):
                ids, own = self.ids[at:min(end, at + 4096)], self.vectors[at:min(end, at + 4096)]
                scores = (q[who] @ own.T.astype(np.float64)).astype(np.int64) if exact else queries[who] @ own.T
                allowed = (scores >= kth[who, None]) & (ids[None, :] != query_ids[who, None])
                rows = allowed.any(axis=1)
                sub, scores, allowed = who[rows], scores[rows], allowed[rows]
                if not len(sub):
                    continue
                all_scores = np.concatenate([best[sub], np.where(allowed, scores, none)], axis=1)
                all_ids = np.concatenate([found[sub], np.where(allowed, ids[None, :], np.iinfo(np.int64).max)], axis=1)
                keep = np.lexsort((all_ids, -all_scores.astype(np.float64) if exact else ~all_scores), axis=1)[:, :k]
                best[sub], found[sub] = np.take_along_axis(all_scores, keep, 1), np.take_along_axis(all_ids, keep, 1)
                full = best[sub, k - 1]
                kth[sub] = np.maximum(kth[sub], full)
        rows, cols = np.nonzero(best > none)
        return rows, found[rows, cols], best[rows, cols]


def _walk(k: int):
    """Per partition: rows come sorted by shard and length, candidates before
    queries. One tree is held at a time, and a batch of queries."""

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)

    def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "dim", "is_query")], axis=1)
        cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                yield batch.slice(i, j - i)

    def run(batches):
        key, held, tree = None, [], None
        for batch in batches:
            for part in runs(batch):
                here = (part.column("shard")[0].as_py(), part.column("dim")[0].as_py())
                if here != key:
                    key, held, tree = here, [], None
                ids, vectors = part.column("id").to_numpy(), matrix(part)
                if not part.column("is_query")[0].as_py():
                    held.append((ids, vectors))
                    continue
                if not held:
                    continue
                if tree is None:
                    tree = BallTree(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                numbers = part.column("qn").to_numpy()
                floor = part.column("floor").to_numpy(zero_copy_only=False)
                for at in range(0, len(ids), 1024):
                    rows, found, scores = tree.search(ids[at:at + 1024], vectors[at:at + 1024], floor[at:at + 1024], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at:at + 1024][rows]), pa.array(numbers[at:at + 1024][rows]), pa.array(found), pa.array(scores)],
                                                     names=["query_id", "qn", "vec_id", "score"])

    return run


def search(rows: DataFrame, queries: DataFrame, k: int, rows_per_shard: int = 16384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` of ``rows`` for each
    row of ``queries`` (both ``id`` long, ``v`` array of long, not null)."""
    rows = materialize(rows.select("id", "v", F.size("v").alias("dim")), "vectors")
    queries = materialize(queries.select("id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("qn")), "queries")
    n = blocks_for(rows.count(), rows_per_shard)
    home = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    candidates = rows.select(home.alias("shard"), "dim", F.lit(False).alias("is_query"), "id", "v", F.lit(0).cast("long").alias("floor"), F.lit(0).cast("long").alias("qn"))

    def walked(asked: DataFrame) -> DataFrame:
        dealt = (candidates.unionByName(asked.select("shard", "dim", F.lit(True).alias("is_query"), "id", "v", "floor", "qn"))
                 .repartition("shard").sortWithinPartitions("shard", "dim", "is_query"))
        return dealt.mapInArrow(_walk(k), "query_id long, qn long, vec_id long, score long")

    lowest = F.lit(-(1 << 63) + 1)
    first = materialize(walked(queries.withColumn("shard", home).withColumn("floor", lowest)), "home-shard")
    # the k-th score of the home shard is a floor for all others; a third column counts that there are k
    floors = first.groupBy("qn").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    if n == 1:
        everything = first
    else:
        asked = (queries.join(floors, "qn", "left")
                 .withColumn("floor", F.coalesce("kth", lowest)).withColumn("home", home)
                 .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).where("shard <> home"))
        everything = first.unionByName(materialize(walked(asked), "other-shards"))
    order = Window.partitionBy("qn").orderBy(F.desc("score"), "vec_id")
    return everything.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
