"""Connected components of links, by alternating stars.

Each round every node links its greater neighbours to its least one, and then its lesser neighbours to
it, until no link changes. Rounds grow with the logarithm of the longest path. Each round is
written to the shared folder, so lineage stays short. Hubs do no harm: least neighbours are partial
aggregates, and joins split large keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiretide.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node that links lead to."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u > v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct()
        large = stored(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u > v").union(
            low.select("u", F.col("low").alias("v"))).distinct()
        following = stored(small, "edges")
        same = following.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(
            following, ["u", "v"], "left_anti").isEmpty()
        edges = following
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
