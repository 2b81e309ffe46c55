"""Communities by moves in tasks: how many tables they write, and graphs of more than one task."""

import numpy as np
import pytest

from quillgraph.operators import graph
from test_graph import distances_by_definition, louvain_by_definition, quality


def planted(n):
    rng = np.random.default_rng(n)
    return [(f"p{a:03}", f"p{b:03}", float(rng.integers(1, 4))) for a in range(n) for b in range(a + 1, n) if rng.random() < (0.3 if a % 5 == b % 5 else 0.04)]


@pytest.mark.parametrize("block", [None, 400])
def test_communities_in_few_rounds(spark, monkeypatch, block):
    """Rounds by single moves of no two neighbours wrote more than a hundred tables here; tasks of few nodes need more than one."""
    written, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df: written.append(1) or settle(df))
    if block:
        monkeypatch.setattr(graph, "BLOCK", block)
    pairs = planted(100)
    got = {r.node: r.community for r in graph.communities(spark.createDataFrame(pairs, "a string, b string, weight double")).collect()}
    assert set(got) == {x for e in pairs for x in e[:2]}
    assert block or len(written) < 60
    assert quality(pairs, got, 1.2) >= quality(pairs, louvain_by_definition(pairs, 1.2), 1.2) - (0.02 if block else 1e-9)
    for c in set(got.values()):
        members = {x for x in got if got[x] == c}
        assert min(members) == c and set(distances_by_definition([e[:2] for e in pairs if set(e[:2]) <= members], c)) == members
