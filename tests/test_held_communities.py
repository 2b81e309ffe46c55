"""Communities whose labels the driver holds: jobs without tables, the quality of the written rounds, connected communities."""

import numpy as np
import pytest

from quillgraph.operators import graph, louvain
from test_graph import distances_by_definition, louvain_by_definition, quality
from test_moves import planted


def found(spark, pairs):
    return {r.node: r.community for r in graph.communities(spark.createDataFrame(pairs, "a string, b string, weight double")).collect()}


@pytest.mark.parametrize("block", [None, 400, 100])
def test_rounds_write_no_tables(spark, monkeypatch, block):
    """Each round wrote a table, whatever the graph's size, and more than one task ended by rounds of a move for each community."""
    pairs, written, settle = planted(100) + [("q1", "q2", 2.0), ("q1", "q1", 1.0)], [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df: written.append(1) or settle(df))
    if block:
        monkeypatch.setattr(graph, "BLOCK", block)
    got = found(spark, pairs)
    # the numbers, both directions, their rows, and those of each level of more than a task
    assert len(written) < (15 if block else 4)
    assert set(got) == {x for e in pairs for x in e[:2]} and got["q1"] == got["q2"] == "q1"
    assert quality(pairs, got, 1.2) >= quality(pairs, louvain_by_definition(pairs, 1.2), 1.2) - (0.02 if block else 1e-9)
    for c in set(got.values()):
        members = {x for x in got if got[x] == c}
        assert min(members) == c and set(distances_by_definition([e[:2] for e in pairs if set(e[:2]) <= members], c)) == members


def test_more_nodes_than_held(spark, monkeypatch):
    pairs = planted(40)
    held = quality(pairs, found(spark, pairs), 1.2)
    monkeypatch.setattr(graph, "HELD", 0)
    assert abs(quality(pairs, found(spark, pairs), 1.2) - held) < 0.02
    assert graph.communities(spark.createDataFrame([], "a string, b string, weight double")).count() == 0


def test_communities_that_are_not_connected_are_split():
    own = np.repeat(np.arange(6), 1)
    rows = louvain.coarse(own, own ^ 1, np.ones(6))
    assert louvain.parts(rows, np.array([0, 0, 0, 0, 1, 1])).tolist() == [0, 0, 2, 2, 4, 4]
    assert louvain.search(rows, 0.0, 6.0).tolist() == [0, 0, 1, 1, 2, 2]
