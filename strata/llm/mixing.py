"""Mixing sources to target weights by Pfair scheduling.

The documents of each source, in a hashed order, are cut into blocks. One
block goes out per time slot. With integer target weights ``a`` summing to
``A``, the j-th block of a source (j from 0) is released at slot
``floor(j * A / a)`` and due by slot ``ceil((j + 1) * A / a)``. Among the
released blocks the one with the earliest deadline goes first. On one channel
this meets every deadline, so after any number t of slots each source is less
than one block away from ``a / A * t``.

The schedule repeats after ``A`` slots, so the driver works out one period
per phase and every block finds its slot by arithmetic. When a source has no
blocks left, a new phase begins in which the others share the channel by
their weights. No document is dropped or repeated.

Defined results
* Sources that the weights do not name (null too) are pooled and share the
  weight of ``OTHER``, which must be there.
* The last block of a source may be short, as may the pool's.
* Rows that repeat each other are separate rows; a null id is an ordinary value.
* An empty table gives no rows. Other columns are carried along.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks_for, fresh, materialize, number_in_groups, row_id

OTHER = "*"
ROWS_PER_NUMBERING_BLOCK = 4096
MAX_SCHEDULE = 2_000_000  # bounds the parameter: classes squared times the sum of weights


def period(weights: Mapping[str, int]) -> list[str]:
    """The classes of one period's slots, earliest deadline first."""
    total = sum(weights.values())
    waiting = [(0, i, c, 0) for i, c in enumerate(weights)]  # release, order, class, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    out: list[str] = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, i, c, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[c]), i, c, j))
        _, i, c, j = heapq.heappop(ready)
        out.append(c)
        heapq.heappush(waiting, ((j + 1) * total // weights[c], i, c, j + 1))
    return out


def schedule(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[dict]:
    """The phases: for each, its first slot, and for each class still there
    the index of its first block, the number that go out, and the places of
    its blocks in a period."""
    left = {c: n for c, n in blocks.items() if n}
    sent, start, phases = dict.fromkeys(left, 0), 0, []
    while left:
        own = {c: weights[c] for c in weights if c in left}
        order, total = period(own), sum(own.values())
        places: dict[str, list[int]] = {c: [] for c in own}
        for slot, c in enumerate(order):
            places[c].append(slot)
        # the phase ends with the slot that takes some class's last block
        length = min((left[c] - 1) // own[c] * total + places[c][(left[c] - 1) % own[c]] + 1 for c in own)
        whole, rest = divmod(length, total)
        took = {c: whole * own[c] + sum(p < rest for p in places[c]) for c in own}
        phases.append({"start": start, "total": total, "weights": own, "first": {c: sent[c] for c in own}, "took": took, "places": places})
        start += length
        for c, n in took.items():
            sent[c] += n
            left[c] -= n
        left = {c: n for c, n in left.items() if n}
    return phases


def _identity(id_col: str, text_col: str, source_col: str) -> Column:
    """A row's identity: one document may come from several sources."""
    return F.concat_ws("|", row_id(F.col(id_col), F.col(text_col)), F.coalesce(F.col(source_col), F.lit("")))


def mix(docs: DataFrame, weights: Mapping[str, int], block_rows: int = 16, seed: int = 0,
        source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, class, rid, block, place,
    phase, slot, release, deadline``. Sorting by ``slot, place`` gives the
    mix. ``release`` and ``deadline`` count slots from the start."""
    if OTHER not in weights or any(not isinstance(w, int) or w < 1 for w in weights.values()):
        raise ValueError(f"weights must be positive integers and name {OTHER!r}")
    if len(weights) ** 2 * sum(weights.values()) > MAX_SCHEDULE:
        raise ValueError("weights too fine: round them to smaller integers")
    spark = docs.sparkSession
    named = [c for c in weights if c != OTHER]
    cls = F.when(F.col(source_col).isin(named), F.col(source_col)).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), cls.alias("class"),
        _identity(id_col, text_col, source_col).alias("rid"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.col(text_col))).alias("_order")), "mix-rows")
    counts = {r["class"]: r["count"] for r in rows.groupBy("class").count().collect()}  # one row per weight
    n_blocks = {c: blocks_for(counts[c], block_rows) for c in weights if c in counts}
    phases = schedule(weights, n_blocks)
    numbering = F.lit(1)
    for c, n in counts.items():
        numbering = F.when(F.col("class") == c, blocks_for(n, ROWS_PER_NUMBERING_BLOCK)).otherwise(numbering)
    numbered = number_in_groups(rows, "class", "_order", numbering, ["rid"], "_no").withColumn("block", F.floor(F.col("_no") / block_rows))
    table = spark.createDataFrame(
        [(c, i, p["start"], p["first"][c], p["first"][c] + p["took"][c], p["weights"][c], p["total"], p["places"][c])
         for i, p in enumerate(phases) for c in p["weights"]],
        "_c string, phase int, _start bigint, _from bigint, _to bigint, _a bigint, _t bigint, _places array<int>")
    j = F.col("block") - F.col("_from")
    a, t = F.col("_a"), F.col("_t")
    within = F.element_at("_places", (j % a + 1).cast("int"))

    def div(x: Column, y: Column) -> Column:
        return F.call_function("div", x, y)

    return (numbered.join(F.broadcast(table), (F.col("class") == F.col("_c")) & (F.col("block") >= F.col("_from")) & (F.col("block") < F.col("_to")))
            .select("doc_id", "source", "class", "rid", "block", (F.col("_no") % block_rows).cast("int").alias("place"), "phase",
                    (F.col("_start") + div(j, a) * t + within).alias("slot"),
                    (F.col("_start") + div(j * t, a)).alias("release"),
                    (F.col("_start") + div((j + 1) * t + a - 1, a)).alias("deadline")))


def with_places(docs: DataFrame, weights: Mapping[str, int], block_rows: int = 16, seed: int = 0, source_col: str = "source",
                id_col: str = "doc_id", text_col: str = "text", rid: str = "rid", slot: str = "slot", place: str = "place") -> DataFrame:
    """All rows of ``docs`` with their identity, slot and place in the mix,
    under the names ``rid``, ``slot`` and ``place``. The same rows get the same
    places, however they are stored; rows that repeat a document share its first."""
    first = mix(docs, weights, block_rows, seed, source_col, id_col, text_col).groupBy("rid").agg(F.min(F.struct("slot", "place")).alias("at"))
    slots = materialize(first.select(F.col("rid").alias(rid), F.col("at.slot").alias(slot), F.col("at.place").alias(place)), "slots")
    return docs.withColumn(rid, _identity(id_col, text_col, source_col)).join(slots, rid)


def in_mixed_order(docs: DataFrame, weights: Mapping[str, int], block_rows: int = 16, seed: int = 0,
                   source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs``, with their columns as they are, sorted in the
    order of the mix: written, the files read one after another give it."""
    rid, slot, place = fresh(docs, "rid"), fresh(docs, "slot"), fresh(docs, "place")
    placed = with_places(docs, weights, block_rows, seed, source_col, id_col, text_col, rid, slot, place)
    return placed.orderBy(slot, place, rid).select(*docs.columns)
