"""Louvain where the driver holds a number for each node: tasks hold the nodes with their neighbours and tell which ones move."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best(now: int, near: list[tuple[int, float]], label: list[int], size: list[float], pull: float) -> tuple[int, float]:
    """The community of most gain for a node that is taken out of its own, and how much more than in its own; pull: of a
    community's strength. Of equal gains its own, then the smallest."""
    to = {}
    for other, weight in near:
        c = label[other]
        to[c] = to[c] + weight if c in to else weight
    found, most = now, to.pop(now, 0.0) - pull * size[now]
    stay = most
    for c, weight in to.items():
        gain = weight - pull * size[c] - most
        if gain > 1e-9 or gain > -1e-9 and found != now and c < found:
            found, most = c, most + gain
    return found, most - stay


class Rows:
    """Nodes with their neighbours: node i of `node` has others[starts[i]:starts[i + 1]]."""

    def __init__(self, node: np.ndarray, k: np.ndarray, loop: np.ndarray, starts: np.ndarray, others: np.ndarray, weights: np.ndarray) -> None:
        self.node, self.k, self.loop, self.starts, self.others, self.weights = node, k, loop, starts, others, weights

    @classmethod
    def of(cls, batches: Iterator[pa.RecordBatch]) -> Rows | None:
        held = [b for b in batches if b.num_rows]
        if not held:
            return None
        rows = pa.Table.from_batches(held).sort_by("node").combine_chunks().to_batches()[0]
        lists = rows.column("others")
        column = lambda c: rows.column(c).to_numpy()
        return cls(column("node"), column("k"), column("loop"), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())], lists.flatten().to_numpy(), rows.column("weights").flatten().to_numpy())

    def inside(self, label: np.ndarray) -> float:
        """Weight within communities."""
        own = np.repeat(label[self.node], np.diff(self.starts))
        return float(self.weights[own == label[self.others]].sum() + self.loop.sum())

    def outer(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(community, community, weight), loops and both directions included."""
        n = int(label.max()) + 1
        own = np.repeat(label[self.node], np.diff(self.starts))
        key, place = np.unique(np.r_[own * n + label[self.others], label[self.node] * (n + 1)], return_inverse=True)
        return key // n, key % n, np.bincount(place.reshape(-1), np.r_[self.weights, self.loop], len(key))

    def move(self, label: np.ndarray, size: np.ndarray, part: float, settled: bool, propose: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Each node's community, and its last gain, once the nodes have moved one after the other: once, or until none of them moves
        (settled). propose: each as if it alone moved."""
        label, size, near = label.tolist(), size.tolist(), list(zip(self.others.tolist(), self.weights.tolist(), strict=True))
        todo = [(i, x, near[s:e], z) for i, (x, s, e, z) in enumerate(zip(self.node.tolist(), self.starts.tolist(), self.starts[1:].tolist(), self.k.tolist(), strict=False))]
        to, gains, moving = self.node.tolist(), [0.0] * len(todo), True
        while moving:
            moving = False
            for i, x, others, z in todo:
                now = label[x]
                size[now] -= z
                to[i], gains[i] = best(now, others, label, size, part * z)
                if propose:
                    size[now] += z
                    continue
                moving |= settled and to[i] != now
                label[x] = to[i]
                size[to[i]] += z
        return np.array(to), np.array(gains)


def dense(label: np.ndarray) -> np.ndarray:
    """Labels as numbers from 0 on, in the same order."""
    return np.unique(label, return_inverse=True)[1].reshape(-1)


def coarse(node: np.ndarray, other: np.ndarray, weight: np.ndarray) -> Rows:
    """Rows of edges (node, other, weight) in order, each node 0 .. n - 1 with one at least."""
    n, loops = int(node.max()) + 1, node == other
    far = ~loops
    return Rows(np.arange(n), np.bincount(node, weight, n), np.bincount(node[loops], weight[loops], n), np.r_[0, np.cumsum(np.bincount(node[far], minlength=n))], other[far], weight[far])


def parts(rows: Rows, label: np.ndarray) -> np.ndarray:
    """The smallest node of each node's connected part of its community; rows are all nodes."""
    own = np.repeat(rows.node, np.diff(rows.starts))
    same = label[own] == label[rows.others]
    own, other, least = own[same], rows.others[same], np.arange(len(label))
    while True:
        new = least.copy()
        np.minimum.at(new, own, least[other])
        new = new[new]
        if (new == least).all():
            return least
        least = new


def search(rows: Rows, part: float, whole: float) -> np.ndarray:
    """A community for each of the nodes 0 .. n - 1 of rows, by passes from the communities found before until a pass gains nothing;
    each community is connected."""
    found, reached = np.arange(len(rows.node)), None
    while True:
        quality = (rows.inside(found) - part * (np.bincount(found, rows.k) ** 2).sum()) / whole
        if reached is not None and quality - reached <= 1e-9:
            split = parts(rows, found)
            if len(np.unique(split)) == len(np.unique(found)):
                return found
            found = dense(split)
            quality = (rows.inside(found) - part * (np.bincount(found, rows.k) ** 2).sum()) / whole
        reached, names, level, label = quality, np.arange(len(rows.node)), rows, found
        while True:
            n = len(level.node)
            label = dense(level.move(label, np.bincount(label, level.k, n), part, True)[0])
            names = label[names]
            if label.max() + 1 == n:
                break
            level = coarse(*level.outer(label))
            label = np.arange(len(level.node))
        found = names


class Held:
    """Nodes 0 .. n - 1 in a table (node, k, loop, others, weights) whose labels the driver holds."""

    def __init__(self, near: DataFrame, part: float, whole: float, block: int) -> None:
        self.near, self.part, self.whole, self.block = near.select("node", "k", "loop", "others", "weights"), part, whole, block
        own = self.near.select("node", "k", F.size("others").cast("long").alias("degree")).toArrow().sort_by("node")
        self.k, self.degree = own.column("k").to_numpy(), own.column("degree").to_numpy()

    def _run(self, f: Callable[[Rows, tuple], pa.RecordBatch], shared: tuple, schema: str, rows: DataFrame | None = None) -> pa.Table:
        sent = self.near.sparkSession.sparkContext.broadcast(shared)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Rows.of(batches)
            if held is not None:
                yield f(held, sent.value)

        out = (self.near if rows is None else rows).mapInArrow(run, schema).toArrow()
        sent.unpersist()
        return out

    def alone(self) -> np.ndarray:
        """search in one task, for tables of up to `block` neighbours."""
        part, whole = self.part, self.whole
        found = self._run(lambda rows, _: pa.RecordBatch.from_arrays([pa.array(rows.node), pa.array(search(rows, part, whole))], ["node", "to"]), (), "node long, to long", self.near.coalesce(1))
        return found.sort_by("node").column("to").to_numpy() if found.num_rows else np.zeros(0, dtype=np.int64)

    def _round(self, label: np.ndarray, propose: bool) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The modularity, and the nodes that move, where to and what each gains."""
        part, size = self.part, np.bincount(label, self.k, len(label))

        def moves(rows: Rows, shared: tuple) -> pa.RecordBatch:
            label, size = shared
            to, gain = rows.move(label, size, part, False, propose)
            go = (to != label[rows.node]) & (gain > 1e-8)
            # node -1: the task's weight within communities
            return pa.RecordBatch.from_arrays([pa.array(np.r_[-1, rows.node[go]]), pa.array(np.r_[0, to[go]]), pa.array(np.r_[rows.inside(label), gain[go]])], ["node", "to", "gain"])

        out = self._run(moves, (label, size), "node long, to long, gain double")
        node, to, gain = (out.column(c).to_numpy() for c in ("node", "to", "gain"))
        go = node >= 0
        return (gain[~go].sum() - part * (size**2).sum()) / self.whole, node[go], to[go], gain[go]

    def _in_turn(self, label: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Labels once these nodes, of up to `block` neighbours, have moved one after the other, in one task, until none moves."""
        part, size = self.part, np.bincount(label, self.k, len(label))
        wanted = np.zeros(len(label), dtype=bool)
        wanted[node] = True
        chosen = self.near.sparkSession.sparkContext.broadcast(wanted)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(chosen.value[batch.column("node").to_numpy()]))

        def moves(rows: Rows, shared: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows.node), pa.array(rows.move(*shared, part, True)[0])], ["node", "to"])

        out = self._run(moves, (label, size), "node long, to long", self.near.mapInArrow(pick, self.near.schema).repartition(1))
        chosen.unpersist()
        after = label.copy()
        after[out.column("node").to_numpy()] = out.column("to").to_numpy()
        return after

    def moved(self, label: np.ndarray, rough: bool) -> tuple[np.ndarray, float]:
        """Labels once no move gains any more; where `rough`, once a round gains less than a twentieth of what all have. With them the
        modularity before. What tasks move at once gains less than they count; once it is less than a twentieth, only so many nodes
        of most gain move as one task can move in turn, whose gains add up exactly."""
        first = before = None
        while True:
            quality, node, to, _ = self._round(label, False)
            first = quality if first is None else first
            gain = np.inf if before is None else quality - before[1]
            if gain <= 1e-9 or before and gain < (quality - first) / 20 or not len(node):
                label = label if gain > 0 else before[0]
                break
            before, label = (label, quality), label.copy()
            label[node] = to
        while not rough:
            _, node, _, gain = self._round(label, True)
            if not len(node):
                break
            order = np.lexsort((node, -np.round(gain, 9)))
            most = np.searchsorted(np.cumsum(self.degree[node[order]]), self.block, "right")
            label = self._in_turn(label, node[order[: max(most, 1)]])
        return label, first

    def outer(self, label: np.ndarray) -> DataFrame:
        """(node, other, weight) of the communities of dense labels, in both directions, loops included."""
        sent = self.near.sparkSession.sparkContext.broadcast(label)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = Rows.of(batches)
            if rows is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows.outer(sent.value)], ["node", "other", "weight"])

        return self.near.mapInArrow(sums, "node long, other long, weight double").groupBy("node", "other").agg(F.sum("weight").alias("weight"))

    def parts(self, label: np.ndarray) -> np.ndarray:
        """The smallest node of each node's connected part of its community: a task tells the smallest that its own nodes see."""
        least = np.arange(len(label))
        while True:

            def sees(rows: Rows, shared: tuple) -> pa.RecordBatch:
                label, least = shared
                own = np.repeat(np.arange(len(rows.node)), np.diff(rows.starts))
                same, new = label[rows.node[own]] == label[rows.others], least[rows.node]
                np.minimum.at(new, own[same], least[rows.others[same]])
                less = new < least[rows.node]
                return pa.RecordBatch.from_arrays([pa.array(rows.node[less]), pa.array(new[less])], ["node", "to"])

            out = self._run(sees, (label, least), "node long, to long")
            if not out.num_rows:
                return least
            least = least.copy()
            least[out.column("node").to_numpy()] = out.column("to").to_numpy()
            while (least[least] != least).any():
                least = least[least]


def communities(near: DataFrame, nodes_of: Callable[[DataFrame], DataFrame], part: float, whole: float, block: int) -> np.ndarray:
    """A community for each node 0 .. n - 1 of near (node, k, loop, others, weights); nodes_of makes such a table of edges (node,
    other, weight) in both directions."""
    top = Held(near, part, whole, block)
    if top.degree.sum() <= block:
        return top.alone()
    found, reached, rough = np.arange(len(top.k)), None, True
    while True:
        label, quality = top.moved(found, rough)
        if reached is not None and not rough and quality - reached <= 1e-9:
            split = top.parts(found)
            if len(np.unique(split)) == len(np.unique(found)):
                return found
            found, reached = split, None
            continue
        reached, held, names = None if rough else quality, top, np.arange(len(top.k))
        while True:
            label = dense(label)
            names = label[names]
            if label.max() + 1 == len(held.k):
                break
            held = Held(nodes_of(held.outer(label)), part, whole, block)
            if held.degree.sum() <= block:
                names = held.alone()[names]
                break
            label, _ = held.moved(np.arange(len(held.k)), rough)
        found, rough = names, False
