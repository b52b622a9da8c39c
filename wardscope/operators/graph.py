"""Proximity graph: size, random walks and features of neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.operators.prefix import PriorTotals, prior_totals
from wardscope.operators.sampling import hash_number, seeded_hash
from wardscope.session import cut_lineage


def graph_stats(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Nodes, undirected edges, isolated nodes and density, in one row. Either direction of an edge counts once."""
    undirected = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    ends = undirected.select(F.explode(F.array("a", "b")).alias(node)).distinct().withColumn("linked", F.lit(1))
    marked = nodes.select(node).distinct().join(ends, node, "left")
    size = marked.agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("linked").isNull()).alias("n_isolates"))
    sized = size.withColumn("n_edges", undirected.agg(F.count(F.lit(1)).alias("m")).scalar())
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1)
    return sized.withColumn("density", F.coalesce(F.try_divide(2.0 * F.col("n_edges"), pairs), F.lit(0.0)))


def numbered_neighbours(edges: DataFrame) -> DataFrame:
    """``src, slot, dst``: neighbours of a node numbered from 0 in sorted order.

    Neighbours stay one per row and are numbered by split running totals, so a node with very many of them
    is no single large value.
    """
    distinct = edges.select("src", "dst").distinct()
    target = F.col("dst").cast("string")
    spec = PriorTotals(["src"], {"slot": F.lit(1)})
    return prior_totals(distinct, [spec], F.substring(target, 1, 2), target, F.md5(target))


def random_walks(edges: DataFrame, length: int = 5, walks: int = 50, seed: int = 42) -> DataFrame:
    """``walk, start, path``: ``walks`` uniform walks of ``length`` nodes from every node with neighbours.

    The next neighbour is chosen by a hash of seed, start, walk number and step; one step is one equi-join of
    all walks at once, on node and neighbour number, which also spreads the walks that stand on a busy node.
    Every end of an edge must have an edge of its own, as in a graph with both directions.
    """
    numbered = cut_lineage(numbered_neighbours(edges))
    degrees = numbered.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    # Each neighbour brings its own degree along, so that a step needs one join.
    slots = cut_lineage(numbered.join(degrees.withColumnRenamed("src", "dst"), "dst", "left"))
    state = degrees.select(F.col("src").alias("start"), F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("walk"),
                           F.col("src").alias("at"), F.col("degree").alias("choices"), F.array("src").alias("path"))
    for step in range(1, length):
        number = hash_number(seeded_hash(seed, F.col("start"), F.col("walk"), F.lit(step)))
        asked = state.select("start", "walk", "path", F.col("at").alias("src"), (number % F.col("choices")).alias("slot"))
        state = asked.join(slots, ["src", "slot"]).select(
            "start", "walk", F.col("dst").alias("at"), F.col("degree").alias("choices"),
            F.concat("path", F.array("dst")).alias("path"))
    return state.select("walk", "start", "path")


def neighbor_features(rows: DataFrame, edges: DataFrame, key: str, week: str, features: Sequence[str],
                      radius: float = 0.06, hops: int = 2) -> DataFrame:
    """Add ``<feature>_hop1`` and ``_hop2``: means over the neighbours in the same week, nearer ones weighing
    more. Without neighbours they are 0. A second hop averages the first-hop values of the neighbours.
    """
    links = edges.select(F.col("src").alias("_to"), F.col("dst").alias(key),
                         (1 / (1 + F.col("dist") / radius)).alias("_w"))
    names = list(features)
    for hop in range(1, hops + 1):
        base = names if hop == 1 else [f"{name}_hop{hop - 1}" for name in names]
        sent = rows.select(key, week, *base).join(links, key)
        means = sent.groupBy(F.col("_to").alias(key), week).agg(*(
            F.try_divide(F.sum(F.col(c) * F.col("_w")), F.sum("_w")).alias(f"{name}_hop{hop}")
            for c, name in zip(base, names)))
        rows = rows.join(means, [key, week], "left").fillna(0.0, subset=[f"{name}_hop{hop}" for name in names])
    return rows
