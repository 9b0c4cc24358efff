"""Connected components of graphs that no machine holds; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldweave.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of the links; the component is one of its nodes, the same for all.

    Each round draws an order of the nodes by hash, joins every node to the first of those within two links of it, and
    goes on with the links between different ones that are left. So a star or a clique goes in one round, and of a chain
    a constant share of the nodes in each on average. Nodes with very many links are aggregated before they are shuffled. A
    round writes what its own nodes are joined to; the rounds are put together once, from the last and smallest to the first.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    links = settle(links, "graph-links")
    rounds = [links.select(F.col("a").alias("v"), F.col("b").alias("head")).limit(0)]
    while not links.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(rank("b")).alias("r")).select("a", F.least("r", rank("a")).alias("r"))
        # The first of a node's neighbours' firsts: none of its own is before it.
        near = links.join(first.withColumnRenamed("r", "a_r"), "a").join(first.select(F.col("a").alias("b"), F.col("r").alias("b_r")), "b")
        near = near.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("b_r").alias("r")), F.struct(F.col("b").alias("v"), F.col("a_r").alias("r")))))
        heads = settle(near.groupBy("v").agg(F.min("r").alias("r")).select("v", F.col("r.v").alias("head")), "graph-heads")
        at = lambda c: heads.select(F.col("v").alias(c), F.col("head").alias(f"{c}_head"))  # noqa: E731, B023
        links = links.join(at("a"), "a").join(at("b"), "b").where("a_head <> b_head")
        links = links.select(F.least("a_head", "b_head").alias("a"), F.greatest("a_head", "b_head").alias("b")).distinct()
        links = settle(links, "graph-links")
        rounds.append(heads)
    out = rounds.pop()
    while len(rounds) > 1:
        onward = out.select(F.col("v").alias("head"), F.col("head").alias("onward"))
        out = rounds.pop().join(onward, "head", "left").select("v", F.coalesce("onward", "head").alias("head"))
    return settle(out.select(F.col("v").alias("node"), F.col("head").alias("component")), "graph-labels")


def carried(labels: DataFrame | None, onward: DataFrame) -> DataFrame:
    """Labels (node, component) after ``onward``, the components of links between components and single nodes."""
    if labels is None:
        return onward
    step = onward.select(F.col("node").alias("component"), F.col("component").alias("later"))
    moved = labels.join(step, "component", "left").select("node", F.coalesce("later", "component").alias("component"))
    return settle(moved.unionByName(onward.join(labels.select("node"), "node", "left_anti")), "graph-labels")
