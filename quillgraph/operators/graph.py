"""Graph operators: canonical edges, degrees, closures, shortest distances, projection, levels, path checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators import louvain
from quillgraph.operators.rounds import discard, settle
from quillgraph.operators.rules import running


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Undirected, without loops, once each: (a, b) with a < b."""
    return edges.filter("source != target").select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).distinct()


def neighbours(canonical: DataFrame) -> DataFrame:
    """(node, other) in both directions."""
    end = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("other"))
    return canonical.select(F.inline(F.array(end("a", "b"), end("b", "a"))))


def degrees(canonical: DataFrame) -> DataFrame:
    return neighbours(canonical).groupBy("node").agg(F.count("*").alias("degree"))


def game_graph(canonical: DataFrame, target: str, generic: DataFrame | None = None, least: int = 2) -> DataFrame:
    """Edges between nodes of degree >= least (counted once, before filtering) and the target; generic nodes go."""
    nodes = degrees(canonical).filter((F.col("degree") >= least) | (F.col("node") == target)).select("node")
    if generic is not None:
        nodes = nodes.join(generic, "node", "left_anti")
    return canonical.join(nodes.withColumnRenamed("node", "a"), "a", "left_semi").join(nodes.withColumnRenamed("node", "b"), "b", "left_semi").select("a", "b")


def distances(canonical: DataFrame, start: str, plain: int = 16, most: int | None = None) -> DataFrame:
    """(node, dist) of unweighted shortest distances, however far: one join, one anti join and one written table for each of
    the first `plain` levels. What lies further out is a graph of long paths: they are contracted by doubling, and levels
    are then counted on what is left. `most` is a distance beyond which there must be no node; if there is one, it is an
    error."""
    spark = canonical.sparkSession
    both = settle(neighbours(canonical))
    front = spark.createDataFrame([(start, 0)], "node string, dist int")
    seen = front = settle(front)
    before = front.limit(0)
    for d in range(1, plain + 1):
        step = both.join(front.select("node"), "node").select(F.col("other").alias("node")).distinct()
        # edges lead both ways, so a neighbour that was seen before is of this level or the last
        near = front.union(before).select("node")
        before, front = front, settle(step.join(near, "node", "left_anti").withColumn("dist", F.lit(d)))
        if front.isEmpty():
            break
        seen = seen.union(front)
    else:
        seen = seen.union(_far(both, seen, front))
    if most is not None and not seen.filter(F.col("dist") > most).isEmpty():
        raise RuntimeError(f"nodes are further than {most}")
    return seen


def _paths(half: DataFrame, inner: DataFrame) -> DataFrame:
    """(node, first, end, steps): from each half (node, other) along inner nodes (node), which have two neighbours, to the first
    node that is none. Each round doubles the steps; if none comes to an end by that, those left are on circles of inner nodes alone,
    which end nowhere and are left out."""
    mark = inner.select(F.col("node").alias("end"), F.lit(True).alias("open"))
    paths = half.select("node", F.col("other").alias("first"), F.col("node").alias("came"), F.col("other").alias("end"), F.lit(1).alias("steps"))
    paths = settle(paths.join(mark, "end", "left").withColumn("open", F.coalesce("open", F.lit(False))))
    before, left = None, paths.filter("open").count()
    while left and left != before:
        on = paths.select(F.col("node").alias("end"), F.col("first").alias("n_first"), F.col("came").alias("n_came"), F.col("end").alias("n_end"), F.col("steps").alias("n_steps"), F.col("open").alias("n_open"))
        longer = paths.filter("open").join(on, "end").filter("n_first != came")
        longer = longer.select(F.col("n_end").alias("end"), "node", "first", F.col("n_came").alias("came"), (F.col("steps") + F.col("n_steps")).alias("steps"), F.col("n_open").alias("open"))
        after = settle(paths.filter("not open").unionByName(longer))
        discard(paths)
        paths, before, left = after, left, after.filter("open").count()
    return paths.filter("not open").select("node", "first", "end", "steps")


def _far(both: DataFrame, seen: DataFrame, front: DataFrame) -> DataFrame:
    """(node, dist) of the nodes beyond `front`, the last level of `seen`."""
    done = seen.join(front.select("node"), "node", "left_anti").select("node")
    ahead = both.join(done, "node", "left_anti").join(done.withColumnRenamed("node", "other"), "other", "left_anti").select("node", "other")
    edge = front.select("node", F.lit(True).alias("own"))
    ahead = ahead.join(edge, "node", "left").join(edge.select(F.col("node").alias("other"), F.col("own").alias("others")), "other", "left")
    half = settle(ahead.filter("own is null or others is null").select("node", "other"))
    inner = half.groupBy("node").count().filter("count = 2").select("node").join(front.select("node"), "node", "left_anti")
    inner = settle(inner)
    paths = settle(_paths(half, inner))
    steps = settle(paths.join(inner, "node", "left_anti").filter("node != end").groupBy("node", "end").agg(F.min("steps").alias("steps")))
    dist = changed = settle(front.select("node", "dist"))
    while True:
        reached = steps.join(changed, "node").groupBy(F.col("end").alias("node")).agg(F.min(F.col("dist") + F.col("steps")).alias("dist"))
        changed = settle(reached.join(dist.withColumnRenamed("dist", "known"), "node", "left").filter("known is null or dist < known").select("node", "dist"))
        if changed.isEmpty():
            break
        dist = settle(dist.union(changed).groupBy("node").agg(F.min("dist").alias("dist")))
    between = paths.join(inner, "node", "left_semi").join(dist.withColumnRenamed("node", "end"), "end").groupBy("node").agg(F.min(F.col("dist") + F.col("steps")).alias("dist"))
    return settle(dist.join(front.select("node"), "node", "left_anti").union(between))


def crawl(edges: DataFrame, roots: list, noisy: DataFrame, most: int = 4) -> DataFrame:
    """(node, depth, parent, noise, path) of a breadth-first crawl over edges (parent, child) from the roots.

    A node is discovered by the parent that comes first in the queue; it is noise if that parent is or if it is in `noisy`
    (node). Noise and nodes of depth `most` are recorded but not descended. `path` orders nodes as the queue does.
    """
    spark = edges.sparkSession
    order = lambda c: F.lpad(c.cast("string"), 12, "0")
    steps = settle(edges.filter("parent != child").distinct())
    marks = noisy.select(F.col("node").alias("child"), F.lit(True).alias("marked")).distinct()
    front = spark.createDataFrame([(r, 0, None, False, f"{i:012d}") for i, r in enumerate(roots)], "node long, depth int, parent long, noise boolean, path string")
    seen = front = settle(front)
    for depth in range(1, most + 1):
        step = steps.join(front.filter("not noise").select(F.col("node").alias("parent"), "path"), "parent").join(seen.select(F.col("node").alias("child")), "child", "left_anti")
        best = step.groupBy("child").agg(F.min(F.struct(F.concat_ws("/", "path", order(F.col("child"))).alias("path"), "parent")).alias("first"))
        front = settle(best.join(marks, "child", "left").select(F.col("child").alias("node"), F.lit(depth).alias("depth"), F.col("first.parent").alias("parent"), F.coalesce("marked", F.lit(False)).alias("noise"), F.col("first.path").alias("path")))
        if front.isEmpty():
            break
        seen = seen.union(front)
    return seen


def crawl_roots(edges: DataFrame, roots: list[tuple[int, int]], noisy: DataFrame) -> DataFrame:
    """(node, root, depth, parent, noise) of crawls from (root, depth) pairs, in order: each has a depth of its own and
    passes over what an earlier one has seen. A root that an earlier one has seen is descended all the same.

    All crawls advance together: a node's label is the smallest (crawl, depth) that a parent's label, or a root that the
    parent is, leads to, and each round labels anew only the children of nodes whose label has changed. An earlier crawl that
    arrives later takes a node away, and its children are labelled again, so rounds follow the depth, not the number of
    roots. Then each depth's nodes of all crawls are ranked as their queues would be, by (parent's rank, node).
    """
    spark = edges.sparkSession
    steps = settle(edges.filter("parent != child").distinct())
    marked = settle(noisy.select("node", F.lit(True).alias("noise")).distinct())
    # the callers' own list
    sources = settle(spark.createDataFrame([(root, i, most) for i, (root, most) in enumerate(roots)], "node long, crawl int, most int"))
    limits, own = F.broadcast(sources.select("crawl", "most")), sources.select("node", "crawl", F.lit(0).alias("depth"))
    best = F.min(F.struct("crawl", "depth")).alias("label")
    label = changed = settle(own.groupBy("node").agg(best).select("node", "label.*"))
    descended = lambda df: df.join(limits, "crawl").filter("depth < most").join(marked, "node", "left_anti").select("node", "crawl", "depth")
    from_roots = settle(own.join(limits, "crawl").filter("depth < most").select("node", "crawl", "depth"))
    while not changed.isEmpty():
        ends = descended(label).unionByName(from_roots).select(F.col("node").alias("parent"), "crawl", (F.col("depth") + 1).alias("depth"))
        hit = steps.join(changed.select(F.col("node").alias("parent")).distinct(), "parent", "left_semi").select("child").distinct()
        into = steps.join(hit, "child", "left_semi").join(ends, "parent").select(F.col("child").alias("node"), "crawl", "depth")
        again = into.unionByName(own.join(hit.withColumnRenamed("child", "node"), "node", "left_semi")).groupBy("node").agg(best).select("node", "label.*")
        hits = hit.withColumnRenamed("child", "node")
        told = settle(hits.join(again, "node", "left").join(label.select("node", F.col("crawl").alias("c0"), F.col("depth").alias("d0")), "node", "left"))
        changed = told.filter("not (crawl <=> c0 and depth <=> d0)").select("node", "crawl", "depth")
        label = settle(label.join(told.select("node"), "node", "left_anti").unionByName(told.filter("crawl is not null").select("node", "crawl", "depth")))
    rank = settle(from_roots.select("node", "crawl", F.col("crawl").cast("long").alias("rank")))
    out = label.filter("depth = 0").select("node", "crawl", "depth", F.lit(None).cast("long").alias("parent"))
    for depth in range(1, max((most for _, most in roots), default=0) + 1):
        level = label.filter(F.col("depth") == depth).select(F.col("node").alias("child"), "crawl")
        queue = rank.withColumnRenamed("node", "parent")
        first = steps.join(level, "child").join(queue, ["parent", "crawl"]).groupBy("child", "crawl").agg(F.min(F.struct("rank", "parent")).alias("first"))
        ranked = settle(running(first.select("crawl", "first.rank", "child", "first.parent"), ["crawl", "rank", "child"], F.lit(1)))
        if ranked.isEmpty():
            break
        out = out.unionByName(ranked.select(F.col("child").alias("node"), "crawl", F.lit(depth).alias("depth"), "parent"))
        rank = settle(descended(ranked.select(F.col("child").alias("node"), "crawl", F.lit(depth).alias("depth"))).join(ranked.select(F.col("child").alias("node"), F.col("before").cast("long").alias("rank")), "node").select("node", "crawl", "rank"))
    named = out.join(F.broadcast(sources.select("crawl", F.col("node").alias("root"))), "crawl").join(marked, "node", "left")
    # a root is descended, and so no noise, whatever its name
    return named.select("node", "root", "depth", "parent", (F.coalesce("noise", F.lit(False)) & (F.col("depth") > 0)).alias("noise"))


def first_with_members(names: list, members: DataFrame) -> DataFrame:
    """The members (name, page) of the first of the names that has any."""
    order = members.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, place int")
    known = members.join(F.broadcast(order), "name")
    return known.filter(F.col("place") == known.agg(F.min("place")).scalar()).select("name", "page")


def crawled_pages(crawled: DataFrame, members: DataFrame, most: int = 4) -> DataFrame:
    """(page, categories) of members (page, node): all the descended categories a page is in, sorted."""
    descended = crawled.filter((F.col("depth") < most) & ~F.col("noise")).select("node")
    return members.join(descended, "node").groupBy("page").agg(F.array_sort(F.collect_set("node")).alias("categories"))


def reach(dist: DataFrame) -> DataFrame:
    return dist.groupBy("dist").agg(F.count("*").alias("nodes"))


def levels(dist: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (lvl, start, slack, expected) -> lvl, start, dist, budget and an error if the audit fails."""
    joined = wanted.join(dist, wanted["start"] == dist["node"], "left")
    error = F.when(F.col("dist").isNull(), "unreachable").when(F.col("expected").isNotNull() & (F.col("dist") != F.col("expected")), "unexpected distance")
    return joined.select("lvl", "start", "dist", (F.col("dist") + F.col("slack")).alias("budget"), error.alias("error"))


def ancestors(parent: DataFrame, depth: int) -> DataFrame:
    """(node, ancestor, dist), self included, up to depth; parent: (node, parent)."""
    up = parent.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
    level = parent.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("dist")).distinct()
    out = level
    for d in range(1, depth + 1):
        level = level.join(up, level["ancestor"] == up["_n"]).select("node", F.col("_p").alias("ancestor"), F.lit(d).alias("dist")).filter("ancestor is not null").distinct()
        out = out.union(level)
    return out.groupBy("node", "ancestor").agg(F.min("dist").alias("dist"))


def nearest_root(parent: DataFrame, roots: DataFrame, depth: int = 6) -> DataFrame:
    """(node, kind, dist): the nearest root by distance, then priority; climbing stops at a root. roots: (root, kind, priority)."""
    up = parent.join(F.broadcast(roots.select(F.col("root").alias("node"))), "node", "left_anti")
    found = ancestors(up.union(roots.select(F.col("root").alias("node"), F.lit(None).cast(parent.schema["parent"].dataType).alias("parent"))), depth)
    best = found.join(F.broadcast(roots), found["ancestor"] == roots["root"]).groupBy("node").agg(F.min(F.struct("dist", "priority", "kind")).alias("best"))
    return best.select("node", "best.kind", "best.dist")


def _sharing(mentions: DataFrame, most: int, both: bool = False) -> DataFrame:
    """(a, n, c, ids, ms): for each hub a of an entity of 2..most hubs, the entity's later hubs (all, itself included, if
    `both`) with their counts, and the entity's weight. So a pair is a few bytes of an array, not a row."""
    size = mentions.groupBy("target").agg(F.count("*").alias("k")).filter(F.col("k").between(2, most))
    kept = mentions.join(size, "target").filter("source is not null")
    lists = kept.groupBy("target", "k").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("hubs"))
    each = lists.select("k", "hubs", F.posexplode("hubs").alias("i", "me"))
    others = F.col("hubs") if both else F.slice("hubs", F.col("i") + 2, F.size("hubs"))
    rows = each.select(F.col("me.source").alias("a"), F.col("me.n").alias("n"), F.log(1 + F.lit(60.0) / F.col("k")).alias("c"), others.alias("others"))
    return rows.select("a", "n", "c", F.col("others.source").alias("ids"), F.col("others.n").alias("ms")).filter(F.size("ids") > 0)


def _summed(rows: DataFrame, k: int | None = None, slack: float = 0.0) -> DataFrame:
    """(a, b, weight): c * sqrt(n * m) over rows (a, n, c, ids, ms). Rows are dealt by a and unpacked and summed there, so
    pairs are never shuffled. With k only those of each a that are less than `slack` below its k-th."""
    kind = rows.schema["a"].dataType.simpleString()
    return rows.repartition("a").sortWithinPartitions("a").mapInArrow(_unpacker(k, slack), f"a {kind}, b {kind}, weight double")


def _unpacker(k: int | None, slack: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over rows in order of a; what a batch's last a has so far goes on into the next batch."""

    def close(a: pa.Array, run: np.ndarray, b: pa.Array, weight: np.ndarray) -> pa.RecordBatch:
        if k is not None:
            order = np.lexsort((-weight, run))
            first = np.flatnonzero(np.r_[True, run[order][1:] != run[order][:-1]])
            size = np.diff(np.r_[first, len(order)])
            least = np.where(size >= k, weight[order[np.minimum(first + k, first + size) - 1]], -np.inf)
            kept = order[weight[order] >= np.repeat(least, size) - slack]
            run, b, weight = run[kept], b.take(pa.array(kept)), weight[kept]
        return pa.RecordBatch.from_arrays([a.take(pa.array(run)), b, pa.array(weight)], ["a", "b", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda c: batch.column(c).to_numpy()  # noqa: B023, E731
            a, lists = batch.column("a"), batch.column("ids")
            length = lists.value_lengths().to_numpy()
            value = np.repeat(column("c"), length) * np.sqrt(np.repeat(column("n"), length) * batch.column("ms").flatten().to_numpy())
            b = lists.flatten()
            if held:
                a, b = pa.concat_arrays([held[0], a]), pa.concat_arrays([held[1], b])
                length, value = np.r_[len(held[1]), length], np.r_[held[2], value]
            new = pc.not_equal(a[1:], a[:-1]).to_numpy(zero_copy_only=False)
            which, starts = np.repeat(np.r_[0, np.cumsum(new)], length), np.flatnonzero(np.r_[True, new])
            codes = b.dictionary_encode()
            names = codes.dictionary
            key = which.astype(np.int64) * len(names) + codes.indices.to_numpy()
            # a hub is no pair with itself
            other = pc.not_equal(a.take(pa.array(starts[which])), b).to_numpy(zero_copy_only=False)
            key, place = np.unique(key[other], return_inverse=True)
            weight = np.bincount(place, value[other], len(key))
            of, b = key // max(len(names), 1), names.take(pa.array(key % max(len(names), 1)))
            done = int(np.searchsorted(of, len(starts) - 1))
            a = a.take(pa.array(starts))
            held = a[-1:], b[done:], weight[done:]
            if done:
                yield close(a, of[:done], b[:done], weight[:done])
        if held and len(held[1]):
            yield close(held[0], np.zeros(len(held[1]), dtype=int), held[1], held[2])

    return run


def co_mentions(mentions: DataFrame, most: int = 60) -> DataFrame:
    """(a, b, weight): hubs that share an entity of 2..most hubs, idf weighted. The bound is on the entity's own hubs and
    part of the definition; it is applied before hubs are listed, so no entity makes over most**2 pairs. Numbers as ids
    are shuffled in less than half the bytes of texts."""
    return _summed(_sharing(mentions, most))


def strongest_co_mentions(mentions: DataFrame, most: int = 60, k: int = 8, places: int = 6, tie: Column | None = None) -> DataFrame:
    """strongest_neighbours of co_mentions that are rounded to so many places, without a table of all pairs: each hub's are
    summed in one place, and only those that may be among its k strongest leave it."""
    both = _summed(_sharing(mentions, most, both=True), k, 2 * 10.0**-places)
    return strongest_of(both.withColumn("weight", F.round("weight", places)), k, tie)


def pair_weights(mentions: DataFrame, hubs: DataFrame, generic: DataFrame, most: int = 60) -> DataFrame:
    """(a, b, weight) of hubs (id): idf-weighted shared entities that aren't generic (id), and three times the weight of
    direct mentions of one hub by another. mentions: (source, target, n), of hubs and others."""
    own = mentions.join(hubs.withColumnRenamed("id", "source"), "source", "left_semi")
    inside = hubs.withColumnRenamed("id", "target")
    shared = own.join(inside, "target", "left_anti").join(generic.withColumnRenamed("id", "target"), "target", "left_anti")
    direct = own.join(inside, "target", "left_semi").filter("source != target")
    one = F.lit(1).cast(own.schema["n"].dataType)
    ends = direct.select(F.least("source", "target").alias("a"), one.alias("n"), (F.col("n") * 3.0).alias("c"), F.array(F.greatest("source", "target")).alias("ids"), F.array(one).alias("ms"))
    return _summed(_sharing(shared, most).unionByName(ends))


def isolates(hubs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The hubs (id) that no pair has."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    return hubs.join(ends, "id", "left_anti")


def strongest_neighbours(pairs: DataFrame, k: int = 8) -> DataFrame:
    """Pairs that are among the k strongest of either end; ties by the neighbour."""
    end = lambda x, y: F.struct(F.col(x).alias("me"), F.col(y).alias("it"))
    return strongest_of(pairs.select("weight", F.inline(F.array(end("a", "b"), end("b", "a")))).select(F.col("me").alias("a"), F.col("it").alias("b"), "weight"), k)


def strongest_of(both: DataFrame, k: int = 8, tie: Column | None = None) -> DataFrame:
    """strongest_neighbours of pairs that come in both directions; `tie` orders equal weights, if not b itself."""
    order = Window.partitionBy("a").orderBy(F.desc("weight"), F.col("b") if tie is None else tie)
    kept = both.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    # each pair once, also where sums of the two directions end in another last bit
    return kept.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("weight").alias("weight"))


def normalized(pairs: DataFrame) -> DataFrame:
    """Weights over their mean."""
    return pairs.withColumn("weight", F.col("weight") / pairs.agg(F.avg("weight")).scalar())


def check_paths(paths: DataFrame, canonical: DataFrame) -> DataFrame:
    """paths (id, path array) -> id, bad_step: the first step (0-based) that is no edge, null if all are."""
    steps = paths.select("id", F.posexplode(F.expr("transform(sequence(1, greatest(size(path) - 1, 1)), i -> struct(path[i - 1] AS x, get(path, i) AS y))")).alias("step", "e"))
    steps = steps.filter("e.y is not null").select("id", "step", F.least("e.x", "e.y").alias("a"), F.greatest("e.x", "e.y").alias("b"))
    bad = steps.join(canonical, ["a", "b"], "left_anti").groupBy("id").agg(F.min("step").alias("bad_step"))
    return paths.select("id").join(bad, "id", "left")


def modularity(both: DataFrame, label: DataFrame, resolution: float) -> float:
    """Of labels (node, community) over weighted edges in both directions (node, other, weight)."""
    own = both.join(label, "node").join(label.select(F.col("node").alias("other"), F.col("community").alias("c2")), "other")
    per = own.groupBy("community").agg(F.sum(F.when(F.col("community") == F.col("c2"), F.col("weight")).otherwise(0.0)).alias("w_in"), F.sum("weight").alias("w"))
    row = per.agg(F.sum("w_in").alias("w_in"), F.sum("w").alias("w"), F.sum(F.col("w") ** 2).alias("q")).first()
    return row["w_in"] / row["w"] - resolution * row["q"] / row["w"] ** 2 if row["w"] else 0.0


def components(both: DataFrame) -> DataFrame:
    """(node, least): the smallest node that each reaches over both (node, other), edges in both directions. In each round a
    node takes its neighbours' smallest label, and then that label's own, so labels come twice as far."""
    label = settle(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("least")))
    while True:
        near = both.join(label.select(F.col("node").alias("other"), F.col("least").alias("m")), "other").groupBy("node").agg(F.min("m").alias("m"))
        stepped = label.join(near, "node").select("node", F.col("least").alias("was"), F.least("least", "m").alias("least"))
        jump = label.select(F.col("node").alias("least"), F.col("least").alias("further"))
        after = settle(stepped.join(jump, "least").select("node", "was", F.least("least", "further").alias("least")))
        if after.filter("was != least").isEmpty():
            return label
        label = after.select("node", "least")


def connected(edges: DataFrame, label: DataFrame) -> DataFrame:
    """label (node, community) with each community split into the parts that its own edges (node, other) connect."""
    ends = edges.filter("node != other").select("node", "other").join(label, "node").join(label.select(F.col("node").alias("other"), F.col("community").alias("c2")), "other")
    parts = components(settle(ends.filter("community = c2").select("node", "other")))
    return settle(label.join(parts, "node", "left").select("node", F.coalesce("least", "node").alias("community")))


#: Neighbours of the nodes that one task moves, about; more make more tasks.
BLOCK = 1 << 18
#: Nodes whose communities the driver holds and sends to every task, at most.
HELD = 1 << 20


def _nodes_of(edges: DataFrame) -> DataFrame:
    """(node, community, k, loop, others, weights): each node, a community of its own, with its neighbours; edges (node, other,
    weight) in both directions."""
    near = F.array_sort(F.collect_list(F.struct("other", "weight")))
    weigh = lambda e: F.aggregate(e, F.lit(0.0), lambda s, x: s + x["weight"])
    rows = edges.groupBy("node").agg(near.alias("e")).withColumn("far", F.filter("e", lambda x: x["other"] != F.col("node")))
    loop = weigh(F.filter("e", lambda x: x["other"] == F.col("node")))
    return settle(rows.select("node", F.col("node").alias("community"), weigh(F.col("e")).alias("k"), loop.alias("loop"), F.col("far.other").alias("others"), F.col("far.weight").alias("weights")))


def _outer(state: DataFrame, label: DataFrame) -> DataFrame:
    """state whose nodes are the communities of label."""
    own = state.drop("community").join(label, "node")
    sent = own.select(F.col("community").alias("c"), F.explode(F.arrays_zip("others", "weights")).alias("e")).select("c", F.col("e.others").alias("node"), F.col("e.weights").alias("weight"))
    edges = sent.join(label, "node").select("c", "community", "weight").union(own.select("community", "community", "loop"))
    return _nodes_of(edges.toDF("node", "other", "weight").groupBy("node", "other").agg(F.sum("weight").alias("weight")))


_STATE = "node long, community long, k double, loop double, others array<long>, weights array<double>, to long, gain double, quality double"


def _best(node: int, near: list[tuple[int, float]], label: dict[int, int], size: dict[int, float], pull: float) -> tuple[int, float]:
    """The community of most gain for a node that is taken out of its own, and how much more than in its own; pull: of a
    community's strength. Of equal gains its own, then the smallest."""
    now, to = label[node], {}
    for other, weight in near:
        c = label[other]
        to[c] = to[c] + weight if c in to else weight
    best, most = now, to.pop(now, 0.0) - pull * size[now]
    stay = most
    for c, weight in to.items():
        gain = weight - pull * size[c] - most
        if gain > 1e-9 or gain > -1e-9 and best != now and c < best:
            best, most = c, most + gain
    return best, most - stay


def _mover(part: float, whole: float, settled: bool, propose: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moves the nodes of a task one after the other, others staying where they are, once, or until none of them moves (settled).
    propose: each as if it alone moved. quality: what each adds to the modularity before the moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("node", "ascending"), ("other", "ascending")])
        column = lambda t, c: t.column(c).to_numpy()
        is_own = pc.is_null(rows.column("other"))
        own, sent = rows.filter(is_own), rows.filter(pc.invert(is_own))
        node, k, loop, community = (column(own, c) for c in ("node", "weight", "loop", "community"))
        other, weight, c2 = (column(sent, c) for c in ("other", "weight", "community"))
        starts = np.searchsorted(column(sent, "node"), np.append(node, np.iinfo(np.int64).max))
        within = np.where(np.repeat(community, np.diff(starts)) == c2, weight, 0.0)
        inside = np.diff(np.r_[0.0, np.cumsum(within)][starts]) + loop
        quality = (inside - part * k * column(own, "total")) / whole
        size = dict(zip(column(rows, "community").tolist(), column(rows, "total").tolist(), strict=True))
        label = dict(zip(other.tolist(), c2.tolist(), strict=True)) | dict(zip(node.tolist(), community.tolist(), strict=True))
        pairs = list(zip(other.tolist(), weight.tolist(), strict=True))
        todo = [(x, pairs[s:e], z) for x, s, e, z in zip(node.tolist(), starts.tolist(), starts[1:].tolist(), k.tolist(), strict=False)]
        to, gains, moving = dict(label), np.zeros(len(todo)), True
        while moving:
            moving = False
            for i, (x, near, z) in enumerate(todo):
                now = label[x]
                size[now] -= z
                to[x], gains[i] = _best(x, near, label, size, part * z)
                if propose:
                    size[now] += z
                    continue
                moving |= settled and to[x] != now
                label[x] = to[x]
                size[to[x]] += z
        lists = [pa.LargeListArray.from_arrays(starts, pa.array(v)).cast(pa.list_(t)) for v, t in ((other, pa.int64()), (weight, pa.float64()))]
        out = [pa.array(node), pa.array(community), pa.array(k), pa.array(loop), *lists, pa.array([to[x] for x in node.tolist()]), pa.array(gains), pa.array(quality)]
        yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in _STATE.split(", ")])

    return run


def _round(state: DataFrame, tasks: int, salt: int, resolution: float, whole: float, propose: bool) -> DataFrame:
    """state after a round: each node tells its neighbours its community and that community's strength, and tasks, dealt anew
    by the salt, move their nodes."""
    now = state.join(state.groupBy("community").agg(F.sum("k").alias("total")), "community")
    own = now.select("node", F.lit(None).cast("long").alias("other"), F.col("k").alias("weight"), "loop", "community", "total")
    sent = now.select(F.explode(F.arrays_zip("others", "weights")).alias("e"), F.col("node").alias("other"), "community", "total")
    sent = sent.select(F.col("e.others").alias("node"), "other", F.col("e.weights").alias("weight"), F.lit(0.0).alias("loop"), "community", "total")
    rows = own.union(sent).repartition(tasks, F.xxhash64("node", F.lit(salt)))
    return settle(rows.mapInArrow(_mover(resolution / whole, whole, tasks == 1, propose), _STATE))


def _settled_moves(state: DataFrame, whole: float, resolution: float, rough: bool) -> tuple[DataFrame, float, int, int]:
    """(node, community) once no move gains any more; where `rough`, once a round gains less than a twentieth of what all have.
    With it: the modularity before, how many nodes and how many communities there are.

    What tasks move at once gains less than they count, in the end nothing. Once it is less than a twentieth, only such nodes move
    as no other that leaves or enters the same community gains more than, so that their gains add up exactly."""
    columns = ["node", "community", "k", "loop", "others", "weights"]
    nodes, degrees = state.agg(F.count("*"), F.sum(F.size("others"))).first()
    tasks = max(1, -(-(degrees or 0) // BLOCK))
    kept, before, first, salt, strict = state.select(columns), None, None, 0, False
    while True:
        after, salt = _round(kept, tasks, salt, resolution, whole, strict), salt + 1
        moves = (F.col("to") != F.col("community")) & (F.col("gain") > 1e-8)
        row = after.agg(F.sum("quality").alias("q"), F.count_if(moves).alias("n"), F.count_distinct("community").alias("now"), F.count_distinct("to").alias("to")).first()
        first = row["q"] if first is None else first
        # also with more tasks, where no node wants to move none gains
        if tasks == 1 or not strict and not row["n"]:
            return after.select("node", F.col("to").alias("community")), first, nodes, row["to"]
        gain = None if before is None else row["q"] - before[1]
        if strict:
            if not row["n"]:
                return after.select("node", "community"), first, nodes, row["now"]
            wanting = after.filter(moves).select("node", "community", "to", F.struct(F.round("gain", 9).alias("gain"), F.xxhash64("node", F.lit(salt)).alias("h"), "node").alias("o"))
            most = wanting.select(F.explode(F.array("community", "to")).alias("c"), "o").groupBy("c").agg(F.max("o").alias("most"))
            for c in ("community", "to"):
                wanting = wanting.join(most.withColumnRenamed("c", c), c).filter("o = most").drop("most")
            kept = settle(after.drop("to").join(wanting.select("node", "to"), "node", "left").withColumn("community", F.coalesce("to", "community")).select(columns))
            discard(after)
        elif gain is not None and (gain <= 1e-9 or gain < (row["q"] - first) / 20):
            best, count = (after, row["now"]) if gain > 0 else (before[0], before[2])
            if rough:
                return best.select("node", "community"), first, nodes, count
            kept, strict = best.select(columns), True
        else:
            if before is not None:
                discard(before[0])
            before, kept = (after, row["q"], row["now"]), after.select("node", F.col("to").alias("community"), "k", "loop", "others", "weights")


def communities(pairs: DataFrame, resolution: float = 1.2) -> DataFrame:
    """(node, community) by modularity (Louvain), each community connected.

    Nodes are dealt to tasks by their number of neighbours. In a round each task moves its own nodes one after the other to
    the neighbouring community of most gain, as far as it knows the others' communities, until no move gains; then
    communities become nodes, and so on until they stay as they are. From the communities that this finds, the whole is
    passed through again, until a pass gains nothing; the first leaves small gains to later ones. Last, communities
    that aren't connected are split, and passes go on if that gains. Ties go by the smaller label, so the result is the same
    each time.

    Of up to HELD nodes the driver holds the communities, so a round is one job without a shuffle or a table, and a graph of
    a task's size is searched whole in one job; see louvain.py.

    pairs (a, b, weight), each pair once. Of more nodes, a table is written each round.
    """
    ends = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    number = settle(running(ends, ["name"], F.lit(1)).select("name", F.col("before").cast("long").alias("id")))
    for c in ("a", "b"):
        pairs = pairs.join(number.select(F.col("name").alias(c), F.col("id").alias(f"{c}_id")), c)
    end = lambda x, y: F.struct(F.col(f"{x}_id").alias("node"), F.col(f"{y}_id").alias("other"), F.col("weight").cast("double").alias("weight"))
    both = settle(pairs.select(F.inline(F.array(end("a", "b"), end("b", "a")))))
    whole, n = both.agg(F.sum("weight"), F.count("*")).first()
    inner = _nodes_of(both)
    if number.count() <= HELD:
        label = louvain.communities(inner, _nodes_of, resolution / (whole or 1.0), whole or 1.0, BLOCK)
        found = pairs.sparkSession.createDataFrame(pa.table({"node": np.arange(len(label)), "community": label}))
    else:
        found = _written_rounds(both, inner, whole or 1.0, n > BLOCK, resolution)
    # a community's name is its smallest node
    least = found.groupBy("community").agg(F.min("node").alias("least"))
    named = found.join(least, "community").join(number.select(F.col("id").alias("node"), F.col("name")), "node")
    return named.join(number.select(F.col("id").alias("least"), F.col("name").alias("least_name")), "least").select(F.col("name").alias("node"), F.col("least_name").alias("community"))


def _written_rounds(both: DataFrame, inner: DataFrame, whole: float, rough: bool, resolution: float) -> DataFrame:
    """communities of both (node, other, weight) whose nodes are inner's, where labels are tables."""
    found, reached = inner.select("node", "community"), None
    while True:
        state, names, level = inner.drop("community").join(found, "node"), found.select("node", F.col("node").alias("community")), 0
        while True:
            label, quality, nodes, count = _settled_moves(state, whole, resolution, rough)
            if not level:
                # the modularity that the pass before has reached
                gain, reached = 1.0 if reached is None else quality - reached, quality
                if gain <= 1e-9 and not rough:
                    break
            if count == nodes:
                break
            names = names.withColumnRenamed("community", "inner").join(label.select(F.col("node").alias("inner"), "community"), "inner").select("node", "community")
            state, level = _outer(state, label), level + 1
        if gain > 1e-9 or rough:
            found, rough = settle(names), False
            continue
        parts = connected(both, found)
        if parts.select("community").distinct().count() == found.select("community").distinct().count():
            return found
        found = parts
