"""Reachability, far distances, communities and the layout, each against a plain version."""

from collections import defaultdict, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.operators import graph, layout, reach


def reached_by_definition(edges):
    up = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            up[a].add(b)
    pairs = set()
    for a in list(up):
        todo = deque(up[a])
        while todo:
            b = todo.popleft()
            if (a, b) not in pairs:
                pairs.add((a, b))
                todo.extend(up.get(b, ()))
    return pairs


def hierarchies():
    rng = np.random.default_rng(11)
    yield "chain", [(i, i + 1) for i in range(1, 400)]
    yield "tail", [(i, i + 1) for i in range(1, 298)] + [(298, 290), (500, 10)]
    yield "long", [(i, i + 1) for i in range(1, 298)]
    yield "circle", [(1, 2), (2, 3), (3, 1), (4, 1), (3, 5), (6, 6), (7, None), (None, 7)]
    # two parents each, forward only
    yield "lattice", [(i, int(p)) for i in range(2, 80) for p in rng.integers(1, i, 2)]
    # edges in any direction: nested circles, and circles that only residual edges close
    yield "tangle", [(int(a), int(b)) for a, b in rng.integers(0, 60, (75, 2))]
    yield "back", [(i, i + 1) for i in range(1, 30)] + [(20, 5), (28, 24), (40, 3), (30, 41)]


@pytest.mark.parametrize("name,edges", list(hierarchies()), ids=lambda x: x if isinstance(x, str) else "")
def test_reach_index(spark, name, edges):
    want = reached_by_definition(edges)
    index = reach.reach_index(spark.createDataFrame([(a, b, 1) for a, b in edges], "node long, parent long, pre int").select("node", "parent"))
    assert {tuple(r) for r in reach.above(index, index.labels).collect()} == want
    nodes = sorted({x for e in edges if None not in e for x in e})
    roots = nodes[:: max(1, len(nodes) // 6)] + [9999]
    got = {tuple(r) for r in reach.below(index, spark.createDataFrame([(r,) for r in roots], "root long")).collect()}
    assert got == {(b, a) for a, b in want if b in roots} | {(r, r) for r in roots if r in nodes}
    asked = [(a, b) for a in nodes[:12] for b in nodes[-12:]] + [(1, 9999)]
    found = {(r.node, r.ancestor): r.reached for r in reach.reaches(index, spark.createDataFrame(asked, "node long, ancestor long")).collect()}
    assert found == {p: p in want or p[0] == p[1] for p in asked}


def test_closure_of_a_thousand_levels(spark):
    chain = spark.range(1, 1000).select(F.col("id").cast("string").alias("node"), (F.col("id") + 1).cast("string").alias("parent"))
    assert reach.closure(chain).count() == 999 * 1000 // 2
    assert reach.closure(chain.limit(0)).count() == 0


def distances_by_definition(edges, start):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    dist, todo = {start: 0}, deque([start])
    while todo:
        a = todo.popleft()
        for b in near[a]:
            if b not in dist:
                dist[b] = dist[a] + 1
                todo.append(b)
    return dist


def test_distances_at_any_depth(spark):
    rng = np.random.default_rng(4)
    name = "n{:05d}".format
    chain = [(name(i), name(i + 1)) for i in range(1000)]
    # branches, a second way round, a dead end, a circle on the way, and circles that nothing reaches
    more = [(name(500), "b1"), ("b1", "b2"), ("b2", name(520)), (name(700), "dead"), (name(300), "c1"), ("c1", "c2"), ("c2", name(300)), ("x1", "x2"), ("x2", "x3"), ("x1", "x3")]
    random = [(f"r{a}", f"r{b}") for a, b in rng.integers(0, 60, (70, 2)) if a != b] + [("r1", name(900))]
    edges = sorted({tuple(sorted(e)) for e in chain + more + random})
    frame = spark.createDataFrame(edges, "a string, b string")
    for plain in (3, 16):
        got = {r.node: r.dist for r in graph.distances(frame, name(0), plain).collect()}
        assert got == distances_by_definition(edges, name(0))
    with pytest.raises(RuntimeError):
        graph.distances(frame, name(0), most=64)
    assert graph.distances(frame.limit(0), "alone").count() == 1


def crawls_by_definition(edges, roots, noisy):
    """A crawl after the other, each with a queue."""
    children = defaultdict(list)
    for p, c in sorted(set(edges)):
        if p != c:
            children[p].append(c)
    seen, out = {}, []
    for root, most in roots:
        queue, own = deque([(root, 0, None, False)]), {root}
        while queue:
            node, depth, parent, noise = queue.popleft()
            if node not in seen:
                out.append((node, root, depth, parent, noise))
            if depth < most and not noise:
                for c in children[node]:
                    if c not in seen and c not in own:
                        own.add(c)
                        queue.append((c, depth + 1, node, c in noisy))
        seen |= dict.fromkeys(own)
    return sorted(out, key=repr)


@pytest.mark.parametrize("n,wanted", [(60, 9), (3000, 1000)])
def test_crawls_of_many_roots(spark, n, wanted):
    rng = np.random.default_rng(n)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, n, (3 * n // 2, 2))]
    roots = [(int(r), int(d)) for r, d in zip(rng.permutation(n)[:wanted], rng.integers(0, 5, wanted), strict=True)] + [(0, 3)]
    noisy = [int(x) for x in rng.integers(0, n, n // 10)]
    frame, marks = spark.createDataFrame(edges, "parent long, child long"), spark.createDataFrame([(x,) for x in noisy], "node long")
    got = graph.crawl_roots(frame, roots, marks).select("node", "root", "depth", "parent", "noise").collect()
    assert sorted(map(tuple, got), key=repr) == crawls_by_definition(edges, roots, set(noisy))


def quality(edges, label, resolution):
    total, inside, strength = 2 * sum(w for *_, w in edges), 0.0, defaultdict(float)
    for a, b, w in edges:
        inside += 2 * w * (label[a] == label[b])
        strength[label[a]] += w
        strength[label[b]] += w
    return inside / total - resolution * sum(k * k for k in strength.values()) / total**2


def louvain_by_definition(edges, resolution):
    """One node after the other, in order, then communities as nodes."""
    names = {x: x for e in edges for x in e[:2]}
    total = 2 * sum(w for *_, w in edges)
    now = [(a, b, w) for a, b, w in edges]
    while True:
        near, k = defaultdict(lambda: defaultdict(float)), defaultdict(float)
        for a, b, w in now:
            k[a] += w
            k[b] += w
            if a != b:
                near[a][b] += w
                near[b][a] += w
        label = {x: x for x in k}
        size, moving = dict(k), True
        while moving:
            moving = False
            for x in sorted(k):
                size[label[x]] -= k[x]
                to = defaultdict(float, {label[x]: 0.0})
                for y, w in near[x].items():
                    to[label[y]] += w
                best = max(sorted(to), key=lambda c: (round(to[c] - resolution * k[x] * size[c] / total, 9), c == label[x]))
                moving |= best != label[x]
                label[x] = best
                size[best] += k[x]
        names = {x: label[c] for x, c in names.items()}
        if len(set(label.values())) == len(label):
            return names
        sums = defaultdict(float)
        for a, b, w in now:
            sums[tuple(sorted((label[a], label[b])))] += w
        now = [(a, b, w) for (a, b), w in sums.items()]


def graphs():
    rng = np.random.default_rng(2)
    yield "cliques", [(f"n{c}{i}", f"n{c}{j}", 1.0) for c in range(6) for i in range(5) for j in range(i + 1, 5)] + [(f"n{c}0", f"n{(c + 1) % 6}1", 0.5) for c in range(6)]
    yield "planted", [(f"p{a:02}", f"p{b:02}", float(rng.integers(1, 4))) for a in range(60) for b in range(a + 1, 60) if rng.random() < (0.5 if a % 4 == b % 4 else 0.05)]
    at = rng.random((70, 2))
    yield "near", [(f"g{a:02}", f"g{b:02}", 1.0) for a in range(70) for b in range(a + 1, 70) if ((at[a] - at[b]) ** 2).sum() < 0.03]


@pytest.mark.parametrize("name,pairs", list(graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_communities(spark, name, pairs):
    got = {r.node: r.community for r in graph.communities(spark.createDataFrame(pairs, "a string, b string, weight double")).collect()}
    assert set(got) == {x for e in pairs for x in e[:2]}
    assert quality(pairs, got, 1.2) >= quality(pairs, louvain_by_definition(pairs, 1.2), 1.2) - 1e-9
    for c in set(got.values()):
        members = {x for x in got if got[x] == c}
        assert min(members) == c and set(distances_by_definition([e[:2] for e in pairs if set(e[:2]) <= members], c)) == members


def test_components_and_splits(spark):
    edges = [(i, i + 1) for i in range(200)] + [(300, 301)]
    both = spark.createDataFrame(edges + [(b, a) for a, b in edges], "node long, other long")
    assert {(r.node, r.least) for r in graph.components(both).collect()} == {(i, 0) for i in range(201)} | {(300, 300), (301, 300)}
    label = spark.createDataFrame([(i, i // 3 % 2) for i in range(201)] + [(300, 0), (301, 7)], "node long, community long")
    got = {r.node: r.community for r in graph.connected(both, label).collect()}
    assert got == {i: i // 3 * 3 for i in range(201)} | {300: 300, 301: 301}


def all_pairs(at, mass):
    gap = at[:, None] - at[None]
    square = (gap**2).sum(-1)
    square[square == 0] = np.inf
    return (gap * (mass[None] / square)[..., None]).sum(1), (mass[None] / np.sqrt(square)).sum(1)


def cells_of(at, mass, depth):
    corner, side = at.min(axis=0), max((at.max(axis=0) - at.min(axis=0)).max(), 1e-6) * 1.0001
    cell = np.floor((at - corner) / side * (1 << depth)).astype(int)
    found, which = np.unique(cell, axis=0, return_inverse=True)
    sums = [np.bincount(which.reshape(-1), v) for v in (mass, mass * at[:, 0], mass * at[:, 1])]
    return layout.pyramid(tuple(corner), side, depth, found[:, 0], found[:, 1], sums[0], np.stack(sums[1:], axis=1))


@pytest.mark.parametrize("depth", [1, 3, 8])
def test_repulsion_is_within_theta(depth):
    rng = np.random.default_rng(depth)
    at, mass = np.concatenate([rng.normal(size=(150, 2)) * 300, rng.normal(size=(50, 2)) * 0.01 + 900, [[5.0, 5.0]] * 3]), rng.integers(1, 9, 203) + 1.0
    exact, scale = all_pairs(at, mass)
    cells = cells_of(at, mass, depth)
    assert np.allclose(layout.repulsion(cells, np.arange(203), at, mass, 1e-6), exact)
    near = layout.repulsion(cells, np.arange(203), at, mass, 0.5)
    # a cell of theta's size at most is off by theta / 2 of its force to the first order
    assert (np.hypot(*(near - exact).T) <= 0.25 * scale).all() and np.hypot(*(near - exact).T).mean() < 0.01 * scale.mean()
    # its neighbourhood is all that a node has to know
    cell = np.clip((at - cells.corner) / cells.side * (1 << depth), 0, (1 << depth) - 1).astype(int)
    for i in range(0, 203, 29):
        around = np.flatnonzero((np.abs(cell - cell[i]) <= layout.border(0.5)).all(axis=1))
        alone = layout.repulsion(cells, np.flatnonzero(around == i), at[around], mass[around], 0.5)
        assert np.allclose(alone, near[i])


def laid_out(a, b, w, at, steps, repulse):
    """The layout with all nodes in one place, as its docstring has it."""
    mass = np.bincount(np.r_[a, b], minlength=len(at)) + 1.0
    old, swing, traction, speed = np.zeros_like(at), np.zeros(len(at)), np.zeros(len(at)), 1.0
    for _ in range(steps):
        if (mass * swing).sum() > 0:
            speed = min((mass * traction).sum() / (mass * swing).sum(), 1.5 * speed)
        force = 10 * mass[:, None] * repulse(at, mass) - mass[:, None] * at / np.maximum(np.hypot(*at.T), 1e-9)[:, None]
        pull = (at[b] - at[a]) * w[:, None]
        np.add.at(force, a, pull)
        np.add.at(force, b, -pull)
        swing, traction = np.hypot(*(force - old).T), np.hypot(*(force + old).T) / 2
        at = at + force * np.minimum(0.1 * speed / (1 + speed * np.sqrt(swing)), 10 / np.maximum(np.hypot(*force.T), 1e-9))[:, None]
        old = force
    return at


def planted(n, k, rng):
    a, b = np.triu_indices(n, 1)
    keep = rng.random(len(a)) < np.where(a % k == b % k, 0.3, 0.01)
    return a[keep], b[keep], np.where(a[keep] % k == b[keep] % k, 5.0, 0.2)


def test_layout_moves_as_by_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(layout, "BLOCK", 2)
    a, b, w = planted(80, 4, np.random.default_rng(1))
    edges = spark.createDataFrame([(f"n{x:02}", f"n{y:02}", float(z)) for x, y, z in zip(a, b, w, strict=True)] + [("n00", "n00", 9.0)], "a string, b string, weight double")
    rows = lambda **k: np.array([(r.x, r.y) for r in sorted(layout.force_layout(edges, **k).collect())])
    start = rows(iterations=0)
    want = laid_out(a, b, w, start, 6, lambda at, mass: all_pairs(at, mass)[0])
    assert len(start) == 80 and np.abs(start).max() <= 500
    assert np.allclose(rows(iterations=6, theta=0.05), want, atol=1e-6)
    assert np.hypot(*(rows(iterations=6) - want).T).mean() < 0.01 * np.hypot(*(want - start).T).mean()
    assert layout.force_layout(edges.limit(0)).count() == 0
    assert layout.force_layout(edges, settled=1e9).count() == 80


def test_layout_separates_as_well_as_all_pairs():
    rng = np.random.default_rng(2)
    a, b, w = planted(200, 5, rng)
    start = rng.uniform(-500, 500, (200, 2))

    def separation(at):
        c = np.arange(200) % 5
        centre = np.stack([at[c == j].mean(axis=0) for j in range(5)])
        return np.sqrt(((at - centre[c]) ** 2).sum() / ((at - at.mean(axis=0)) ** 2).sum())

    exact = separation(laid_out(a, b, w, start, 250, lambda at, mass: all_pairs(at, mass)[0]))
    near = separation(laid_out(a, b, w, start, 250, lambda at, mass: layout.repulsion(cells_of(at, mass, 3), np.arange(200), at, mass, 0.5)))
    assert near <= exact + 0.01 < 0.15
