"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import release, staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the links (a, b): the smallest node reachable. Nodes without a link to another are left out.

    Alternates large-star and small-star steps, each a grouped minimum: every node hands its neighbours to the
    smallest one it knows, so long chains shorten by half a round and a hub's links turn into a star. The minima are
    written before they are joined, so that the join can split a hub with many links; no group is collected.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large)
        down = staged(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = staged(small.where("u <> v").distinct())
        same = new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty()
        release(edges, low, large, down)
        edges = new
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
