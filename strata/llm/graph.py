"""Connected components of a distributed graph, by alternating stars.

Each round links every node's neighbours to the smallest node around it
("large star", then "small star"). The edge set shrinks towards one star per
component in a logarithmic number of rounds. Every step is an aggregate and a
join over tables written to the shared folder, so hub nodes are pre-aggregated
and their joins can be split; nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    joined = edges.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (columns ``a``, ``b``), where
    ``root`` is the smallest node of the component. Self links are ignored."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == seen or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = now
        edges = materialize(_small_star(materialize(_large_star(edges), "large")), "small")
