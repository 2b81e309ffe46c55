"""Pairs of hubs against plain versions, and that they are summed where they are made."""

import math
import random
from collections import defaultdict

import pytest

from quillgraph.operators import graph


def mentions_of(kind, seed):
    rng = random.Random(seed)
    name = {"long": int, "string": lambda i: f"é{i}"}[kind]
    rows = {(name(rng.randrange(30)), rng.randrange(40)): rng.randint(1, 5) for _ in range(400)}
    # an entity of all hubs is beyond the bound, one of a single hub below it
    rows |= {(name(i), 100): 1 for i in range(30)} | {(name(3), 101): 2}
    return [(s, t, n) for (s, t), n in rows.items()]


def weights(rows, most):
    hubs = defaultdict(dict)
    for s, t, n in rows:
        hubs[t][s] = n
    out = defaultdict(float)
    for of in hubs.values():
        if 2 <= len(of) <= most:
            for a in of:
                for b in of:
                    if a < b:
                        out[a, b] += math.log(1 + 60 / len(of)) * math.sqrt(of[a] * of[b])
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
def test_co_mentions(spark, kind):
    rows = mentions_of(kind, 1)
    mentions, want = spark.createDataFrame([*rows, (rows[0][0], None, 1)], f"source {kind}, target long, n long"), weights(rows, 29)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.a, r.b): r.weight for r in graph.co_mentions(mentions, 29).collect()}
        best = {(r.a, r.b): r.weight for r in graph.strongest_co_mentions(mentions, 29, 3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == pytest.approx(want) and want
    near = defaultdict(list)
    for (a, b), w in want.items():
        near[a].append((-round(w, 6), b, (a, b)))
        near[b].append((-round(w, 6), a, (a, b)))
    top = {x[2] for of in near.values() for x in sorted(of)[:3]}
    assert best == pytest.approx({p: round(want[p], 6) for p in top})


def test_pairs_are_not_shuffled(spark):
    mentions = spark.createDataFrame(mentions_of("long", 2), "source long, target long, n long")
    ids = lambda x: spark.createDataFrame([(i,) for i in x], "id long")
    for pairs in (graph.co_mentions(mentions), graph.pair_weights(mentions, ids(range(30)), ids([5]))):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(a" in plan and "hashpartitioning(b" not in plan
        assert not [x for x in plan.split("\n") if "hashpartitioning(a" in x and ", b#" in x.split("hashpartitioning(")[1].split(")")[0]]
        # the sums are made above the last exchange
        assert plan.index("MapInArrow") < plan.index("Exchange")


def test_pair_weights(spark):
    rows = mentions_of("long", 3)
    hubs, generic = range(0, 30, 2), {5, 7}
    ids = lambda x: spark.createDataFrame([(i,) for i in x], "id long")
    got = {(r.a, r.b): r.weight for r in graph.pair_weights(spark.createDataFrame(rows, "source long, target long, n long"), ids(hubs), ids(generic)).collect()}
    own = [r for r in rows if r[0] in hubs]
    want = weights([r for r in own if r[1] not in hubs and r[1] not in generic], 60)
    for s, t, n in own:
        if t in hubs and s != t:
            want[min(s, t), max(s, t)] += 3.0 * n
    assert got == pytest.approx(want)
