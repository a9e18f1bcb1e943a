"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Each node links its larger neighbours to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return both.join(stage(low, name), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest."""
    low = stage(edges.groupBy("a").agg(F.min("b").alias("low")), name)
    met = edges.join(low, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return low.select("a", F.col("low").alias("b")).unionByName(met).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; ``root`` is the
    smallest node of its component (roots themselves are not listed).

    Every round is written to the shared folder, and so are the smallest
    neighbours before they are joined: the centre of a large star is then a
    skewed join key, which Spark splits, and not a key of an aggregate in the
    same stage. The rounds end when the edge set no longer changes, after about
    log(longest chain) of them. Nulls and
    self-links are ignored; an empty edge table gives an empty result."""
    cur = edges.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    mark = None
    while True:
        cur = stage(cur, name)
        seen = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark or seen[0] == 0:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
        cur = _small_star(stage(_large_star(cur, name), name), name)
