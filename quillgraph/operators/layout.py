"""Positions: centroids, cluster summaries, separation, normalisation, placement and a force layout."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.rounds import discard, settle
from quillgraph.operators.rules import running


def weighted_centroids(links: DataFrame) -> DataFrame:
    """links (id, x, y, w, cluster) -> id, x, y and the cluster of most weight, ties to the smaller."""
    votes = links.groupBy("id", "cluster").agg(F.sum("w").alias("w"), F.sum(F.col("x") * F.col("w")).alias("xw"), F.sum(F.col("y") * F.col("w")).alias("yw"))
    best = F.max_by("cluster", F.struct(F.round("w", 6), -F.col("cluster")))
    return votes.groupBy("id").agg((F.sum("xw") / F.sum("w")).alias("x"), (F.sum("yw") / F.sum("w")).alias("y"), best.alias("cluster"))


def cluster_summary(points: DataFrame, least: int = 5) -> DataFrame:
    """points (id, x, y, cluster) -> cluster, n, x, y and a rank by size, ties to the smaller old number."""
    sums = points.groupBy("cluster").agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y")).filter(F.col("n") >= least)
    # one row for each cluster
    return sums.withColumn("number", F.row_number().over(Window.orderBy(F.desc("n"), "cluster")) - 1)


def separation(points: DataFrame) -> DataFrame:
    """sqrt(sum of squares within clusters / in all): one row."""
    s = points.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"), F.sum(F.col("x") ** 2 + F.col("y") ** 2).alias("q"))
    within = F.sum(F.col("q") - (F.col("x") ** 2 + F.col("y") ** 2) / F.col("n"))
    total = F.sum("q") - (F.sum("x") ** 2 + F.sum("y") ** 2) / F.sum("n")
    return s.agg(F.sqrt(within / total).alias("separation"))


def nearest_rank(df: DataFrame, value: str, q: float) -> DataFrame:
    """The value at sorted position floor(q * n), from running counts of distinct values: one row."""
    counts = df.groupBy(value).agg(F.count("*").alias("c"))
    n = df.agg(F.count("*")).scalar()
    upto = running(counts, [value], F.col("c"))
    return upto.filter(F.col("before") + F.col("c") > F.floor(q * n)).agg(F.min(value).alias("quantile"))


def normalize(points: DataFrame, radius: float = 1000.0) -> DataFrame:
    """Centred, scaled so that the 98 % distance is `radius`, what lies further out compressed logarithmically."""
    centre = points.agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    moved = points.join(F.broadcast(centre)).withColumns({"x": F.col("x") - F.col("cx"), "y": F.col("y") - F.col("cy")}).drop("cx", "cy").withColumn("d", F.hypot("x", "y"))
    scaled = moved.join(F.broadcast(nearest_rank(moved, "d", 0.98))).withColumns({c: F.col(c) / F.col("quantile") * radius for c in ("x", "y", "d")})
    factor = F.when(F.col("d") > radius, radius * (1 + 0.15 * F.log(F.col("d") / radius)) / F.col("d")).otherwise(1.0)
    return scaled.withColumns({"x": F.col("x") * factor, "y": F.col("y") * factor}).drop("d", "quantile")


def place(nodes: DataFrame, centroids: DataFrame, order: list) -> DataFrame:
    """nodes (id, n) at their centroid with a jitter of 18 + 30 / sqrt(n), seeded by the id; those without one, in their
    order, on a ring of radius 1200, each a golden angle on from the last."""
    unit = lambda salt: (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_003)) / 1_000_003.0 - 0.5)
    spread = 18 + 30 / F.sqrt(F.greatest("n", F.lit(1)))
    joined = nodes.join(centroids.select("id", "x", "y"), "id", "left")
    near = joined.filter("x is not null").select("id", (F.col("x") + unit(1) * spread * 2).alias("x"), (F.col("y") + unit(2) * spread * 2).alias("y"))
    angle = F.col("before") * F.lit(2.399963)
    ring = running(joined.filter("x is null").drop("x", "y"), order, F.lit(1)).select("id", (F.cos(angle) * 1200).alias("x"), (F.sin(angle) * 1200).alias("y"))
    return near.union(ring)


def rounded(c: Column, places: int = 1) -> Column:
    """Halves go up, also below zero."""
    return F.floor(c * 10**places + 0.5) / 10**places


def within_clusters(pairs: DataFrame, label: DataFrame, inside: float = 5.0, between: float = 0.2) -> DataFrame:
    """pairs (a, b, weight) with weights times `inside` in a community of label (node, community), else times `between`."""
    ends = [label.select(F.col("node").alias(end), F.col("community").alias(f"c{end}")) for end in ("a", "b")]
    joined = pairs.join(ends[0], "a").join(ends[1], "b")
    return joined.select("a", "b", (F.col("weight") * F.when(F.col("ca") == F.col("cb"), inside).otherwise(between)).alias("weight"))


class Pyramid(NamedTuple):
    """Cells of a square by levels, 4**level at most, each level in Morton order: their masses, centres of mass and, for each,
    where its cells of the next level begin and end. corner, side: of the square."""

    corner: tuple[float, float]
    side: float
    codes: list[np.ndarray]
    mass: list[np.ndarray]
    centre: list[np.ndarray]
    below: list[np.ndarray]


def spread(v: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**16, each with a zero before it."""
    v = v.astype(np.uint64)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def pyramid(corner: tuple[float, float], side: float, depth: int, cx: np.ndarray, cy: np.ndarray, mass: np.ndarray, at: np.ndarray) -> Pyramid:
    """Of the occupied cells (cx, cy) of the finest level, their masses and mass-weighted sums of positions (n, 2)."""
    code = spread(cx) | (spread(cy) << np.uint64(1))
    order = np.argsort(code)
    codes, masses, sums, below = [code[order]], [mass[order]], [at[order]], []
    for _ in range(depth):
        up, first = np.unique(codes[0] >> np.uint64(2), return_index=True)
        below.insert(0, np.stack([first, np.append(first[1:], len(codes[0]))], axis=1))
        codes.insert(0, up)
        masses.insert(0, np.add.reduceat(masses[0], first))
        sums.insert(0, np.add.reduceat(sums[0], first, axis=0))
    return Pyramid(corner, side, codes, masses, [s / m[:, None] for s, m in zip(sums, masses, strict=True)], below)


def _each(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place) for the places start[i] .. end[i] - 1 of every i."""
    n = end - start
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + start[which]


def repulsion(cells: Pyramid, own: np.ndarray, present: np.ndarray, mass: np.ndarray, theta: float, chunk: int = 1024, most: int = 1 << 14) -> np.ndarray:
    """Sums of mass * gap / distance**2 that each of `own` (indices into present) feels: of a cell as a whole where its side is
    under theta times its distance from the node's group of cells, of each node where even a finest cell isn't. present (n, 2):
    own nodes and all others within `border(theta)` finest cells of them, with their mass. A group's nodes share one list of cells
    and nodes that repel them."""
    depth = len(cells.codes) - 1
    up, out = min(GROUP, depth), np.zeros((len(own), 2))
    cx, cy = np.clip((present - cells.corner) / cells.side * (1 << depth), 0, (1 << depth) - 1).astype(np.int64).T
    code = spread(cx) | (spread(cy) << np.uint64(1))
    order = np.argsort(code, kind="stable")
    x, y, m = present[order, 0], present[order, 1], mass[order]
    start, end = np.searchsorted(code[order], cells.codes[depth]), np.searchsorted(code[order], cells.codes[depth], "right")
    turn = np.argsort(code[own], kind="stable")
    first = np.unique(code[own[turn]] >> np.uint64(2 * up), return_index=True)[1]
    last, wide = np.append(first[1:], len(own)), cells.side / (1 << depth - up)
    (x0, y0), forces, buffers = present[own[turn]].T.copy(), np.zeros_like(out), np.empty((4, most))
    low = np.stack([(c[own[turn[first]]] >> up) * wide + z for c, z in zip((cx, cy), cells.corner, strict=True)])
    for s in range(0, len(first), chunk):
        box, found = low[:, s : s + chunk], []
        n = box.shape[1]
        group, cell = np.repeat(np.arange(n), len(cells.codes[0])), np.tile(np.arange(len(cells.codes[0])), n)
        for level in range(depth + 1):
            at = [cells.centre[level][:, axis][cell] for axis in range(2)]
            gap = [np.maximum(0.0, np.maximum(box[axis][group] - at[axis], at[axis] - box[axis][group] - wide)) for axis in range(2)]
            far = (cells.side / (1 << level)) ** 2 < theta * theta * (gap[0] * gap[0] + gap[1] * gap[1])
            found.append((group[far], at[0][far], at[1][far], cells.mass[level][cell[far]]))
            group, cell = group[~far], cell[~far]
            if level < depth:
                which, cell = _each(cells.below[level][cell, 0], cells.below[level][cell, 1])
                group = group[which]
        which, place = _each(start[cell], end[cell])
        found.append((group[which], x[place], y[place], m[place]))
        of, sx, sy, sm = (np.concatenate(c) for c in zip(*found, strict=True))
        by = np.argsort(of, kind="stable")
        sx, sy, sm, ends = sx[by], sy[by], sm[by], np.r_[0, np.cumsum(np.bincount(of, minlength=n))].tolist()
        for g in range(n):
            fx, fy, fm = (v[ends[g] : ends[g + 1]] for v in (sx, sy, sm))
            if len(fx) > buffers.shape[1]:
                buffers = np.empty((4, len(fx)))
            step = max(1, most // max(len(fx), 1))
            for t in range(first[s + g], last[s + g], step):
                u = min(t + step, last[s + g])
                # in place: a new array for each step takes as long as its arithmetic
                dx, dy, push, square = (v[: (u - t) * len(fx)].reshape(u - t, len(fx)) for v in buffers)
                np.subtract(x0[t:u, None], fx, out=dx)
                np.subtract(y0[t:u, None], fy, out=dy)
                np.multiply(dx, dx, out=square)
                square += np.multiply(dy, dy, out=push)
                # nodes in one place, the node itself among them, don't move each other: their gap of zero stays zero
                square += 1e-290
                np.divide(fm, square, out=push)
                forces[t:u, 0], forces[t:u, 1] = np.einsum("ij,ij->i", dx, push), np.einsum("ij,ij->i", dy, push)
    out[turn] = forces
    return out


def border(theta: float) -> int:
    """Finest cells between a node and a node of a cell that isn't far from its group, at most."""
    return math.ceil(1 / theta) + (1 << GROUP)


#: Levels from the finest cells up to the groups whose nodes share a list of what repels them.
GROUP = 2
#: Cells of the finest level, along a side at most: their table, which every task gets, has 2**(2 * DEEPEST) rows at most.
DEEPEST, BLOCK = 8, 16
#: Nodes whose positions every task gets, at most, and nodes for each such task, at least.
HELD, TASK = 1 << 20, 1024


def force_layout(edges: DataFrame, iterations: int = 2000, theta: float = 0.5, scaling: float = 10.0, gravity: float = 1.0, slow: float = 3.0, seed: int = 20260922, settled: float = 4e-3) -> DataFrame:
    """(id, x, y): a layout of edges (a, b, weight), each once, by attraction along edges, repulsion by mass (one more than
    the degree) and gravity, for so many iterations, or until nodes move less than `settled` of the mean radius.

    An iteration sums the nodes in the cells of a quadtree (at most 4**DEEPEST rows, whatever the graph's size) and sends
    each node to its block of cells and to the blocks it borders. There, far cells repel as a whole, and the nodes of near
    cells each by themselves. Attraction is one join of the edges with the positions. Of up to HELD nodes, every task gets all
    positions instead, so that an iteration is one job without a shuffle. How far a node moves is slowed by how
    much its force swings. Begins anywhere between -500 and 500, by a hash of the id. No edges: no rows.
    """
    spark = edges.sparkSession
    both = settle(edges.filter("a != b").select("a", "b", F.col("weight").cast("double").alias("weight")).select("weight", F.inline(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))))
    nodes = both.groupBy("id").agg((F.count("*") + 1.0).alias("mass"), F.sum("weight").alias("strength"))
    place = lambda salt: (F.pmod(F.xxhash64("id", F.lit(seed + salt)), F.lit(1_000_003)) / 1_000_003.0 - 0.5) * 1000
    zero = F.lit(0.0)
    if both.select("id").distinct().count() <= HELD:
        return _held(both, nodes.select("id", "mass", place(0).alias("x"), place(1).alias("y")), iterations, theta, scaling, gravity, slow, settled)
    state = settle(nodes.select("id", "mass", "strength", place(0).alias("x"), place(1).alias("y"), zero.alias("fx"), zero.alias("fy"), zero.alias("swing"), zero.alias("traction"), zero.alias("moved")))
    sums = [F.count("*").alias("n"), F.sum(F.col("mass") * F.col("swing")).alias("swing"), F.sum(F.col("mass") * F.col("traction")).alias("traction"), F.avg("moved").alias("moved"), F.avg(F.hypot("x", "y")).alias("radius")]
    sums += [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x", "y")]
    schema = state.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    speed = 1.0
    for i in range(iterations):
        now = state.agg(*sums).first()
        if not now["n"] or i and now["moved"] < settled * now["radius"]:
            break
        if now["swing"] > 0:
            speed = min(now["traction"] / now["swing"], 1.5 * speed)
        side = max(now["max_x"] - now["min_x"], now["max_y"] - now["min_y"], 1e-6) * 1.0001
        depth = min(DEEPEST, max(1, math.ceil(math.log(max(now["n"] / 4, 1), 4))))
        cell = lambda c: F.floor((F.col(c) - F.lit(now[f"min_{c}"])) / side * (1 << depth))  # noqa: B023, E731
        table = state.groupBy(cell("x").alias("cx"), cell("y").alias("cy")).agg(F.sum("mass").alias("m"), F.sum(F.col("mass") * F.col("x")).alias("sx"), F.sum(F.col("mass") * F.col("y")).alias("sy")).toPandas()
        cells = pyramid((now["min_x"], now["min_y"]), side, depth, table.cx.to_numpy(), table.cy.to_numpy(), table.m.to_numpy(), table[["sx", "sy"]].to_numpy())
        pull = both.join(state.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy")), "other").groupBy("id").agg(F.sum(F.col("weight") * F.col("ox")).alias("px"), F.sum(F.col("weight") * F.col("oy")).alias("py"))
        reach = border(theta)
        blocks = lambda c: F.sequence(F.greatest(F.floor((cell(c) - reach) / BLOCK), F.lit(0).cast("long")), F.floor((cell(c) + reach) / BLOCK))  # noqa: B023, E731
        block = lambda bx, by: (bx * F.lit(1 << 20) + by).cast("long")
        home = block(F.floor(cell("x") / BLOCK), F.floor(cell("y") / BLOCK))
        sent = state.join(pull, "id").withColumn("home", home).withColumn("bx", F.explode(blocks("x"))).withColumn("block", F.explode(F.transform(blocks("y"), lambda by: block(F.col("bx"), by))))
        move = _mover(spark.sparkContext.broadcast(cells), speed, theta, scaling, gravity, slow)
        after = settle(sent.drop("bx").repartition("block").sortWithinPartitions("block").mapInArrow(move, schema))
        discard(state)
        state = after
    return state.select("id", "x", "y")


def _swung(force: np.ndarray, old: np.ndarray, speed: float, slow: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far nodes move, their swing and their traction."""
    swing, traction, size = np.hypot(*(force - old).T), np.hypot(*(force + old).T) / 2, np.maximum(np.hypot(*force.T), 1e-9)
    step = np.minimum(0.3 * speed / (1 + speed * np.sqrt(swing)), 30 / size) / slow
    return force * step[:, None], swing, traction


def _held(both: DataFrame, nodes: DataFrame, iterations: int, theta: float, scaling: float, gravity: float, slow: float, settled: float) -> DataFrame:
    """force_layout where positions are few enough to be sent to every task: tasks hold nodes with their neighbours, and return how
    those are pulled and how the nodes of the task's share of all groups of cells are pushed."""
    spark = both.sparkSession
    number = settle(running(nodes, ["id"], F.lit(1)).withColumn("i", F.col("before").cast("long")).drop("before"))
    first = number.select("i", "mass", "x", "y").toArrow().sort_by("i")
    mass, *at = (first.column(c).to_numpy() for c in ("mass", "x", "y"))
    at = np.stack(at, axis=1)
    ends = both.join(number.select("id", "i"), "id").join(number.select(F.col("id").alias("other"), F.col("i").alias("j")), "other")
    near = ends.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "weight"))).alias("e")).select("i", F.col("e.j").alias("j"), F.col("e.weight").alias("w"))
    shares = max(1, min(spark.sparkContext.defaultParallelism, len(at) // TASK))
    packed = settle(near).repartition(shares).mapInArrow(_packed, "rows binary").rdd.map(lambda row: bytes(row.rows)).persist(StorageLevel.MEMORY_AND_DISK)
    old, moved, swing, traction, speed = np.zeros_like(at), np.zeros_like(at), np.zeros(len(at)), np.zeros(len(at)), 1.0
    for i in range(iterations):
        if not len(at) or i and np.hypot(*moved.T).mean() < settled * np.hypot(*at.T).mean():
            break
        if (mass * swing).sum() > 0:
            speed = min((mass * traction).sum() / (mass * swing).sum(), 1.5 * speed)
        shared = spark.sparkContext.broadcast((_cells(at, mass), at, mass))
        told = packed.map(_forces(shared, theta, shares)).collect()
        shared.unpersist()
        force = np.zeros_like(at)
        for own, pull, pushed, push in told:
            force[own] += pull
            force[pushed] += scaling * mass[pushed][:, None] * push
        force -= gravity * mass[:, None] * at / np.maximum(np.hypot(*at.T), 1e-9)[:, None]
        moved, swing, traction = _swung(force, old, speed, slow)
        at, old = at + moved, force
    packed.unpersist()
    places = pa.table({"i": np.arange(len(at)), "x": at[:, 0], "y": at[:, 1]})
    return number.select("id", "i").join(spark.createDataFrame(places), "i").select("id", "x", "y")


def _cells(at: np.ndarray, mass: np.ndarray) -> Pyramid:
    corner, side = at.min(axis=0), max((at.max(axis=0) - at.min(axis=0)).max(), 1e-6) * 1.0001
    depth = min(DEEPEST, max(1, math.ceil(math.log(max(len(at) / 4, 1), 4))))
    cx, cy = np.floor((at - corner) / side * (1 << depth)).astype(np.int64).T
    sums = [np.bincount((cx << depth) + cy, v, 4**depth) for v in (mass, mass * at[:, 0], mass * at[:, 1])]
    cell = np.flatnonzero(sums[0])
    return pyramid((float(corner[0]), float(corner[1])), side, depth, cell >> depth, cell & (1 << depth) - 1, sums[0][cell], np.stack([v[cell] for v in sums[1:]], axis=1))


def _share(cells: Pyramid, at: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The nodes of this part of all groups of cells, whole groups only, by their places."""
    depth = len(cells.codes) - 1
    cx, cy = np.clip((at - cells.corner) / cells.side * (1 << depth), 0, (1 << depth) - 1).astype(np.int64).T >> min(GROUP, depth)
    group = spread(cx) | (spread(cy) << np.uint64(1))
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], group[order])
    return order[first * parts // len(at) == part]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's nodes i with their neighbours j of weights w, as arrays, and the task's number."""
    rows = [([b.column("i").to_numpy()], [b.column("j").value_lengths().to_numpy()], [b.column("j").flatten().to_numpy()], [b.column("w").flatten().to_numpy()]) for b in batches]
    none = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
    arrays = [np.concatenate([x for part in parts for x in part]) for parts in zip(none, *rows, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((*arrays, TaskContext.get().partitionId()))])], ["rows"])


def _forces(shared: Broadcast, theta: float, shares: int) -> Callable[[bytes], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """How a task's nodes are pulled by their neighbours, and the nodes of its share of all groups of cells pushed by all."""

    def run(rows: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        cells, at, mass = shared.value
        own, length, other, weight, share = pickle.loads(rows)
        which = np.repeat(np.arange(len(own)), length)
        pull = np.stack([np.bincount(which, (at[other, axis] - at[own[which], axis]) * weight, len(own)) for axis in range(2)], axis=1)
        mine = _share(cells, at, share, shares)
        return own, pull, mine, repulsion(cells, mine, at, mass, theta)

    return run


def _mover(shared: Broadcast, speed: float, theta: float, scaling: float, gravity: float, slow: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moves the home nodes of each block, a run of rows."""

    def close(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        column = lambda c: rows.column(c).to_numpy()
        own = np.flatnonzero(column("home") == column("block"))
        if not len(own):
            return
        present, mass = np.stack([column("x"), column("y")], axis=1), column("mass")
        at, m = present[own], mass[own][:, None]
        force = scaling * m * repulsion(shared.value, own, present, mass, theta)
        force -= gravity * m * at / np.maximum(np.hypot(*at.T), 1e-9)[:, None]
        force += np.stack([column("px"), column("py")], axis=1)[own] - column("strength")[own][:, None] * at
        old = np.stack([column("fx"), column("fy")], axis=1)[own]
        moved, swing, traction = _swung(force, old, speed, slow)
        kept = rows.take(pa.array(own)).select(["id", "mass", "strength"]).combine_chunks().to_batches()[0]
        more = {"x": at[:, 0] + moved[:, 0], "y": at[:, 1] + moved[:, 1], "fx": force[:, 0], "fy": force[:, 1], "swing": swing, "traction": traction, "moved": np.hypot(*moved.T)}
        yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, more.values())], [*kept.schema.names, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_block = [], None
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if block[s] != held_block and held:
                    yield from close(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(s, e - s))
                held_block = block[s]
        if held:
            yield from close(pa.Table.from_batches(held))

    return run
