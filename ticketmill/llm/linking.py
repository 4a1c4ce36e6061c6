"""Components of similar sets whose members share buckets, without all pairs of a bucket.

In each bucket the heaviest node leads. Every node is compared first with the
leader that it shares most buckets with, then with the other leaders of its
buckets, as far as they don't follow the same one. Buckets whose nodes are then
still in different components get more leaders, many times as many in each round,
until no two nodes of a bucket are both uncompared and in different components.
So a bucket of near copies costs about one comparison for each node, and every
link between nodes of one bucket is in the result, directly or over others.

A node has a bound for each of its buckets: what it can share with another node
that it meets there first. Only nodes whose bounds are enough for their sizes are
compared. Comparisons are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.common import staged
from ticketmill.llm.components import components

#: By how much the number of leaders of a bucket grows from round to round.
GROWTH = 64


def _can_be_similar(x: str, y: str, similar: float) -> Column:
    """What both can share is enough for sets of their sizes."""
    least = F.least(F.col(f"{x}.bound"), F.col(f"{y}.bound"))
    return (1 + similar) * least >= similar * (F.col(f"{x}.size") + F.col(f"{y}.size")) - 1e-6


def similar_pairs(spark: SparkSession, pairs: DataFrame, cells: DataFrame, similar: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose Jaccard similarity is ``similar`` or more, staged. ``cells``: node, size, cells."""
    one = cells.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("cells").alias("cells_b"))
    two = cells.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("cells").alias("cells_a"))
    both = F.size(F.array_intersect("cells_a", "cells_b"))
    every = F.col("size_a") + F.col("size_b") - both
    close = pairs.select("a", "b").join(one, "b").join(two, "a").where(both.cast("double") >= every.cast("double") * similar - 1e-9)
    return staged(spark, close.select("a", "b"), "linked")


def _with_component(nodes: DataFrame, groups: DataFrame | None, node: str = "node", component: str = "component") -> DataFrame:
    """``nodes`` with the component of the column ``node``: itself where it has no link."""
    if groups is None:
        return nodes.withColumn(component, F.col(node))
    of = groups.select(F.col("node").alias(node), F.col("component").alias(component))
    return nodes.join(of, node, "left").withColumn(component, F.coalesce(component, node))


def grouped(spark: SparkSession, members: DataFrame, cells: DataFrame, similar: float) -> DataFrame | None:
    """``node`` and ``component`` (its smallest node) of all linked nodes; None without links.

    ``members``: bucket, node, weight, size (of the set) and bound (how much it can share with a node that it meets there first).
    """
    links, met = led(spark, members, cells, similar)
    return finished(spark, members, cells, similar, links, met, 1)


def led(spark: SparkSession, members: DataFrame, cells: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """The links of nodes to their buckets' leaders, as far as these matter, and the pairs that this has settled."""
    heaviest = F.max(F.struct("weight", (-F.col("node")).alias("minus"), "size", "bound")).alias("top")
    leaders = members.groupBy("bucket").agg(heaviest, F.count("*").alias("n")).where("n > 1")
    leaders = leaders.select("bucket", (-F.col("top.minus")).alias("node"), "top.size", "top.bound").alias("l")
    met = members.alias("m").join(leaders, (F.col("m.bucket") == F.col("l.bucket")) & (F.col("m.node") != F.col("l.node")) & _can_be_similar("m", "l", similar))
    met = met.groupBy(F.col("l.node").alias("a"), F.col("m.node").alias("b")).agg(F.count("*").alias("often"))
    met = staged(spark, met, "met")
    best = met.groupBy("b").agg(F.max(F.struct("often", (-F.col("a")).alias("minus"))).alias("top"))
    best = staged(spark, best.select((-F.col("top.minus")).alias("a"), "b"), "best")
    followed = similar_pairs(spark, best, cells, similar)
    # A node and a leader that both follow the same one, or one the other, need no comparison.
    follows = followed.select(F.col("b").alias("node"), F.col("a").alias("component"))
    rest = met.select("a", "b").join(best, ["a", "b"], "left_anti")
    rest = _with_component(_with_component(rest, follows, "a", "of_a"), follows, "b", "of_b")
    rest = rest.where("of_a <> of_b and of_a <> b and of_b <> a").select("a", "b")
    links = followed.unionByName(similar_pairs(spark, staged(spark, rest, "rest"), cells, similar))
    return links, met.select("a", "b")


def grouped_by(spark: SparkSession, links: DataFrame) -> DataFrame | None:
    return None if links.isEmpty() else staged(spark, components(spark, links), "groups")


def apart(spark: SparkSession, members: DataFrame, groups: DataFrame | None, similar: float) -> DataFrame:
    """The members, with ``component``, of buckets whose nodes are in different components, staged.

    Members whose bound is too low even for the smallest set of their bucket are left out.
    """
    now = _with_component(members, groups)
    mixed = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("smallest"))
    mixed = mixed.where("low <> high").select("bucket", "smallest")
    enough = (1 + similar) * F.col("bound") >= similar * (F.col("size") + F.col("smallest")) - 1e-6
    return staged(spark, now.join(mixed, "bucket").where(enough).drop("smallest"), "mixed")


def finished(
    spark: SparkSession, members: DataFrame, cells: DataFrame, similar: float, links: DataFrame, done: DataFrame, n_passed: int = 0
) -> DataFrame | None:
    """The components, once no two nodes of a bucket are uncompared and in different ones.

    ``links`` are known and the pairs ``done`` settled; that many leaders of each bucket have been compared with all of it.
    """
    groups, left, n_leaders = grouped_by(spark, links), members, GROWTH
    in_bucket = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "node")
    while True:
        now = apart(spark, left, groups, similar)
        if now.isEmpty():
            return groups
        # Leaders that all others of the bucket have been compared with leave it, the next ones take their place.
        placed = now.withColumn("place", F.row_number().over(in_bucket)).where(F.col("place") <= n_passed + n_leaders)
        placed = staged(spark, placed, "leaders")
        passed, leaders = placed.where(F.col("place") <= n_passed), placed.where(F.col("place") > n_passed)
        rest = now.join(passed.select("bucket", "node"), ["bucket", "node"], "left_anti")
        different = (F.col("m.bucket") == F.col("l.bucket")) & (F.col("m.component") != F.col("l.component"))
        met = rest.alias("m").join(leaders.alias("l"), different & _can_be_similar("m", "l", similar))
        met = met.select(F.least("l.node", "m.node").alias("a"), F.greatest("l.node", "m.node").alias("b")).distinct()
        met = met.join(done, ["a", "b"], "left_anti").join(done.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        met = staged(spark, met, "met")
        done = done.unionByName(met)
        if not met.isEmpty():
            found = similar_pairs(spark, met, cells, similar)
            if not found.isEmpty():
                links = links.unionByName(found)
                groups = grouped_by(spark, links)
        left, n_passed, n_leaders = rest.drop("component"), n_leaders, n_leaders * GROWTH
