"""Connected components of an edge table, by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import drop_path, materialize

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b), of one orderable type, without nulls -> (node, component): the smallest node that node reaches.

    A large star links each node's larger neighbours to its smallest one, a small star its smaller ones. The smallest
    member of a neighbourhood is found by a partial aggregation, and no list of a node's neighbours is ever collected. A
    hub's edges do meet that member in one partition of a join; as nothing above the join needs its order, Spark's skew
    handling may split it. Rounds grow with the logarithm of the longest path. No edges: no rows.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b"), F.col("a"))) if large else e
        # in a small star, edges are kept from the larger end to the smaller
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        joined = both.join(least, both["a"] == least["n"])
        if large:
            return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = least.filter("n != m").select(F.col("n").alias("a"), F.col("m").alias("b"))
        return joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()

    current = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    mark = print_of(current)
    for _ in range(MAX_ROUNDS if mark[0] else 0):
        after = materialize(star(star(current, True), False), "stars")
        now = print_of(after)
        drop_path(current)
        current = after
        if now == mark:
            break
        mark = now
    else:
        if mark[0]:
            raise RuntimeError("components did not settle")
    # settled edges all lead to the smallest member
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select(F.col("b"), F.col("b")).distinct())
