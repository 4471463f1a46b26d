"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargoweave.llm.common import staged

#: Bits of the random part of a node's order; those above hold its number of neighbours.
RANDOM_BITS = 57


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of ``edges`` (a, b long).

    Each round merges every node into the neighbour (or itself) that comes first, and renames
    the edges by it. Nodes of more neighbours (in powers of two) come first, so a star is done
    in one round, whatever its hub's number; of equal ones a random order of the round decides,
    so a chain halves about every round. Counts and minima are combined before the shuffle, so
    a hub is no hot group. Loops and NULL ends are ignored.
    """
    edges = staged(edges.select("a", "b").where("a <> b"), "edges")
    labels = None
    round_ = 0
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        chance = F.xxhash64(F.lit(round_), "node").bitwiseAND(F.lit(2**RANDOM_BITS - 1))
        order = chance - F.floor(F.log2("degree")).cast("long") * F.lit(2**RANDOM_BITS)
        ordered = both.groupBy("node").agg(F.count("*").alias("degree")).select(F.col("node").alias("other"), order.alias("order"))
        parents = staged(
            both.join(ordered, "other").select("node", "other", "order")
            .unionByName(ordered.select(F.col("other").alias("node"), "other", "order"))
            .groupBy("node").agg(F.min_by("other", "order").alias("parent")),
            "parents",
        )
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            labels = staged(
                labels.join(parents.withColumnsRenamed({"node": "label"}), "label", "left")
                .select("node", F.coalesce("parent", "label").alias("label")),
                "labels",
            )
        edges = staged(
            edges.join(parents.withColumnsRenamed({"node": "a", "parent": "pa"}), "a")
            .join(parents.withColumnsRenamed({"node": "b", "parent": "pb"}), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "edges",
        )
        round_ += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
