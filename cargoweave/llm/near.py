"""Links between members of buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cargoweave.llm.common import staged
from cargoweave.llm.graph import components

#: Stars before what is left of a bucket is compared pair by pair, and the share of a star's pairs
#: that has to be linked for another. Both decide what is cheaper, and change no result.
STARS, WORTH = 8, 0.02


def linked_components(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    attach: Callable[[DataFrame], DataFrame] = lambda df: df,
    likely: Callable[[], Column] = lambda: F.lit(True),
) -> DataFrame:
    """(node, component) of the graph whose links are the pairs that share a bucket and pass
    ``verify``; nodes without a link are absent.

    ``buckets`` (bucket, id long), each pair once. ``verify`` takes pairs (a, b) and returns those
    that are links. Groups of thousands of copies share buckets, so their pairs are not written
    out: the members of a bucket are compared with one of them, which joins a group of copies at
    once. That is repeated with fresh pivots, each of the largest component of its bucket and
    compared with the members of others only, as long as that links enough. Pivots are members
    that share large buckets with many, the same ones in all buckets if possible: they are
    the likeliest to be near to all.

    Only pairs of one bucket that lie in different components after that can still change
    anything; those are compared, all of them. ``attach`` adds columns to the members of such
    buckets, and ``likely`` is an exact or safe test over them (prefixes ``l_`` and ``r_``), made
    inside the join, so that only what passes is written.
    """
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = staged(buckets.join(sizes, "bucket"), "members")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    rest = staged(
        members.join(weights, "id").select("bucket", "id", "weight", F.col("id").alias("component"), F.lit(False).alias("used")), "rest"
    )
    none = buckets.select(F.col("id").alias("node"), F.col("id").alias("component")).limit(0)
    if rest.isEmpty():
        return none
    found = compared = None
    for _ in range(STARS):
        pivots = staged(_pivots(rest), "pivots")
        pairs = staged(
            rest.join(pivots, "bucket").where("component <> pivot_component")
            .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(),
            "star",
        )
        compared = pairs if compared is None else compared.unionByName(pairs)
        links = staged(verify(pairs).select("a", "b"), "links")
        n_links = links.count()
        if n_links == 0:
            break
        edges = links if found is None else links.unionByName(found.toDF("a", "b"))
        found = staged(components(edges), "found")
        rest = staged(_open(rest, pivots, found), "rest")
        if rest.isEmpty():
            return found
        if n_links < WORTH * pairs.count():
            break
    found = none if found is None else found
    sides = attach(rest.select("bucket", "id", "component").distinct())
    left, right = (
        sides.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in sides.columns if c != "bucket"]) for side in "lr"
    )
    crossing = (
        left.join(right, (left["bucket"] == right["bucket"]) & F.expr("l_component <> r_component and l_id < r_id") & likely())
        .select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))
        .distinct()
        .join(compared, ["a", "b"], "left_anti")
    )
    more = verify(staged(crossing, "crossing")).select("a", "b")
    return staged(components(found.toDF("a", "b").unionByName(more)), "found")


def _pivots(rest: DataFrame) -> DataFrame:
    """(bucket, pivot, pivot_component): of each bucket's largest component that has a member
    which was no pivot yet the weightiest of these. Counted before the shuffle, so that a hot bucket
    is no hot group."""
    order = F.struct("weight", F.col("id").alias("by"))
    parts = rest.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.max(F.when(~F.col("used"), order)).alias("best")
    ).where("best is not null")
    return parts.groupBy("bucket").agg(
        F.max(F.struct("n", "best", "component")).alias("top")
    ).select("bucket", F.col("top.best.by").alias("pivot"), F.col("top.component").alias("pivot_component"))


def _open(rest: DataFrame, pivots: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that still lie in several components, with those of ``found``."""
    past = pivots.select("bucket", F.col("pivot").alias("id"), F.lit(True).alias("now"))
    labelled = rest.drop("component").join(found.withColumnsRenamed({"node": "id"}), "id", "left").select(
        "bucket", "id", "weight", F.coalesce("component", "id").alias("component"), "used"
    )
    split = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    still = labelled.join(split.where("low < high").select("bucket"), "bucket", "left_semi")
    return still.join(past, ["bucket", "id"], "left").select(
        "bucket", "id", "weight", "component", (F.col("used") | F.coalesce("now", F.lit(False))).alias("used")
    )
