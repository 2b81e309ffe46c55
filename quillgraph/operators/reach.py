"""A reachability index of a hierarchy with several parents and circles: tree intervals and a small residual cover.

Every node keeps one of its parents. Circles of kept edges are condensed, again until none is left; what remains is a
forest, and its nodes' places in preorder give each node an interval that holds the intervals of all below it. Edges that
the forest doesn't imply are the residual; only these are closed, so a hop leads from an interval to a node. Paths, sizes,
places and the residual are all followed by doubling: rounds grow with the logarithm of the depth, and nothing stops at
a depth. (Where many nodes have one ancestor, joins with it rely on Spark's handling of skew.)

`a` is above `x` if a's interval holds x's place, or if a hop's interval holds x and a's interval holds the hop's end.
Containment is joined on equal keys: an interval is a few aligned blocks of places, a place is in one block of each size.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.operators.rounds import settle
from quillgraph.operators.rules import running

#: Blocks have 2**0 .. 2**TOP places; longer intervals have several of the largest, so that no key has many places.
TOP = 12


class Reach(NamedTuple):
    """labels: (node, top, pre, post), `top` standing for the node's circle. hops: (pre, post, to): from the places pre..post to
    the place `to` and all above it. loops: (node) that are a parent of their own."""

    labels: DataFrame
    hops: DataFrame
    loops: DataFrame


def contained(points: DataFrame, place: str, intervals: DataFrame) -> DataFrame:
    """points joined with the intervals (pre, post and other columns) that hold their place."""
    own = F.transform(F.sequence(F.lit(0), F.lit(TOP)), lambda k: F.struct(k.alias("k"), F.call_function("shiftright", F.col(place), k).alias("block")))
    first = lambda k: F.call_function("shiftright", F.col("pre") + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k)
    end = lambda k: F.call_function("shiftright", F.col("post") + 1, k)
    # of each size at most a block at either end, and of the largest as many as there are
    single = lambda b, k: F.struct(k.alias("k"), b.alias("block"))
    sides = F.transform(F.sequence(F.lit(0), F.lit(TOP - 1)), lambda k: F.when(first(k) < end(k), F.filter(F.array(F.when(first(k) % 2 == 1, single(first(k), k)), F.when(end(k) % 2 == 1, single(end(k) - 1, k))), lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<k:int,block:bigint>>")))
    top = F.lit(TOP)
    largest = F.when(first(top) < end(top), F.transform(F.sequence(first(top), end(top) - 1), lambda b: single(b, top))).otherwise(F.array().cast("array<struct<k:int,block:bigint>>"))
    blocks = intervals.select("*", F.explode(F.concat(F.flatten(sides), largest)).alias("_b"))
    return points.select("*", F.explode(own).alias("_b")).join(blocks, "_b").drop("_b")


def _circles(up: DataFrame) -> DataFrame:
    """(node, top): the nodes of circles of up (node, parent), one parent each, with the smallest node of their circle.

    Each round doubles the steps. A node whose path ends has no circle above it; once a round ends no path, all that are left
    lead to circles, and after as many steps as they are many, all have come to one and have gone around it."""
    ahead = settle(up.select("node", F.col("parent").alias("at"), F.col("node").alias("low")))
    steps, before, left = 1, None, ahead.count()
    while left and (left != before or steps < 2 * left):
        far = ahead.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("low").alias("next_low"))
        ahead = settle(ahead.join(far, "at").select("node", F.col("next").alias("at"), F.least("low", "next_low").alias("low")))
        steps, before, left = 2 * steps, left, ahead.count()
    return ahead.join(ahead.select(F.col("at").alias("node")).distinct(), "node", "left_semi").select("node", F.col("low").alias("top"))


def _places(forest: DataFrame) -> DataFrame:
    """(node, pre, post) of forest (node, parent; null: a root): its place in preorder and the last place below it.

    In round k, a node's size grows by the sizes of the nodes 2**k below it. Offsets among siblings come from one running
    sum over (parent, node), and places are their sums along the path up, doubled likewise."""
    state = settle(forest.select("node", F.col("parent").alias("at"), F.lit(1).cast("long").alias("size")))
    twice = lambda df: df.filter("at is not null").join(df.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col(df.columns[-1]).alias("more")), "at")
    while not state.filter("at is not null").isEmpty():
        more = state.filter("at is not null").groupBy(F.col("at").alias("node")).agg(F.sum("size").alias("more"))
        ahead = state.select("node", "at").join(state.select(F.col("node").alias("at"), F.col("at").alias("next")), "at", "left").select("node", F.col("next").alias("at"))
        state = settle(ahead.join(state.select("node", "size"), "node").join(more, "node", "left").select("node", "at", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
    sized = running(forest.join(state.select("node", "size"), "node"), ["parent", "node"], F.col("size"))
    sized = settle(sized.withColumn("before", F.col("before").cast("long")))
    first = sized.filter("parent is not null").groupBy("parent").agg(F.min("before").alias("first"))
    offset = sized.join(first, "parent", "left").withColumn("offset", F.when(F.col("parent").isNull(), F.col("before")).otherwise(F.col("before") - F.col("first") + 1))
    path = settle(offset.select("node", F.col("parent").alias("at"), "offset"))
    while not path.filter("at is not null").isEmpty():
        longer = twice(path).select("node", F.col("next").alias("at"), (F.col("offset") + F.col("more")).alias("offset"))
        path = settle(path.filter("at is null").union(longer))
    return path.join(state.select("node", "size"), "node").select("node", F.col("offset").alias("pre"), (F.col("offset") + F.col("size") - 1).alias("post"))


def reach_index(parent: DataFrame) -> Reach:
    """The index of parent (node, parent): edges up, of any number, with circles. Rows without a parent are ignored."""
    edges = settle(parent.filter("node is not null and parent is not null").select("node", "parent").distinct())
    loops = edges.filter("node = parent").select("node")
    nodes = edges.select("node").union(edges.select("parent")).distinct()
    label = settle(nodes.select("node", F.col("node").alias("top")))
    above = settle(edges.filter("node != parent"))
    while True:
        kept = settle(above.groupBy("node").agg(F.min("parent").alias("parent")))
        circles = settle(_circles(kept))
        if circles.isEmpty():
            break
        renamed = lambda df, c: df.join(circles.select(F.col("node").alias(c), F.col("top").alias("_top")), c, "left").withColumn(c, F.coalesce("_top", c)).drop("_top")
        label = settle(renamed(label, "top"))
        above = settle(renamed(renamed(above, "node"), "parent").filter("node != parent").select("node", "parent").distinct())
    forest = label.select(F.col("top").alias("node")).distinct().join(kept, "node", "left")
    places = settle(_places(forest))
    ends = above.join(kept, ["node", "parent"], "left_anti").join(places, "node").join(places.select(F.col("node").alias("parent"), F.col("pre").alias("to"), F.col("post").alias("to_post")), "parent")
    # an edge to a node that is above anyhow is no residual
    hops = settle(ends.filter("not (to <= pre and pre <= to_post)").select("pre", "post", "to").distinct())
    while True:
        step = contained(hops.select(F.col("pre").alias("from_pre"), F.col("post").alias("from_post"), "to"), "to", hops.withColumnRenamed("to", "next"))
        more = step.select(F.col("from_pre").alias("pre"), F.col("from_post").alias("post"), F.col("next").alias("to")).distinct().join(hops, ["pre", "post", "to"], "left_anti")
        more = settle(more)
        if more.isEmpty():
            break
        hops = settle(hops.union(more))
    return Reach(settle(label.join(places.withColumnRenamed("node", "top"), "top").select("node", "top", "pre", "post")), hops, settle(loops))


def closure(parent: DataFrame) -> DataFrame:
    """Transitive (node, ancestor) pairs of parent (node, parent), a graph that may have several parents and circles."""
    index = reach_index(parent)
    return above(index, index.labels)


def below(index: Reach, roots: DataFrame) -> DataFrame:
    """(root, node): the nodes from which roots (root) are reached, the roots that are known included."""
    known = roots.select("root").distinct().join(index.labels.withColumnRenamed("node", "root"), "root").select("root", "pre", "post")
    through = contained(index.hops.withColumnRenamed("pre", "from_pre").withColumnRenamed("post", "from_post"), "to", known).select("root", F.col("from_pre").alias("pre"), F.col("from_post").alias("post"))
    return contained(index.labels.select("node", F.col("pre").alias("place")), "place", known.union(through).distinct()).select("root", "node").distinct()


def above(index: Reach, nodes: DataFrame) -> DataFrame:
    """(node, ancestor): what nodes (node) reach, by one step or more; the node itself only if it is on a circle."""
    own = nodes.select("node").distinct().join(index.labels, "node").select("node", "top", F.col("pre").alias("place"))
    holders = index.labels.select(F.col("node").alias("ancestor"), F.col("top").alias("ancestor_top"), "pre", "post")
    tree = contained(own, "place", holders)
    # a circle's nodes reach each other, themselves too; any other node is no ancestor of its own by the tree alone
    size = index.labels.groupBy("top").agg((F.count("*") > 1).alias("circle"))
    tree = tree.filter("ancestor != node").select("node", "ancestor").union(own.join(size.filter("circle"), "top").select("node", F.col("node").alias("ancestor")))
    hopped = contained(own.select("node", "place"), "place", index.hops).select("node", "to").distinct()
    return tree.union(contained(hopped, "to", holders).select("node", "ancestor")).union(own.join(index.loops, "node").select("node", F.col("node").alias("ancestor"))).distinct()


def reaches(index: Reach, pairs: DataFrame) -> DataFrame:
    """pairs (node, ancestor) with `reached`: whether the ancestor is the node or above it, found for each pair by itself."""
    ends = index.labels.select(F.col("node").alias("ancestor"), F.col("pre").alias("low"), F.col("post").alias("high"))
    asked = pairs.select("node", "ancestor").distinct().join(index.labels.select("node", F.col("pre").alias("place")), "node").join(ends, "ancestor")
    by_tree = asked.filter("place between low and high").select("node", "ancestor")
    by_hop = contained(asked, "place", index.hops).filter("to between low and high").select("node", "ancestor")
    return pairs.join(by_tree.union(by_hop).distinct().withColumn("reached", F.lit(True)), ["node", "ancestor"], "left").withColumn("reached", F.coalesce("reached", F.lit(False)))
