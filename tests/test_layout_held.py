"""The layout where every task gets all positions, against the one by blocks of cells."""

import numpy as np

from quillgraph.operators import layout
from test_graph import planted


def test_held_positions_move_as_blocks_do(spark, monkeypatch):
    """An iteration wrote a table, whatever the graph's size."""
    written, settle = [], layout.settle
    monkeypatch.setattr(layout, "settle", lambda df: written.append(1) or settle(df))
    monkeypatch.setattr(layout, "BLOCK", 2)
    a, b, w = planted(80, 4, np.random.default_rng(3))
    edges = spark.createDataFrame([(f"n{x:02}", f"n{y:02}", float(z)) for x, y, z in zip(a, b, w, strict=True)] + [("n00", "n00", 9.0)], "a string, b string, weight double")
    rows = lambda k: sorted(layout.force_layout(edges, k).collect())
    held = rows(8)
    assert len(written) < 8
    monkeypatch.setattr(layout, "HELD", 0)
    blocks = rows(8)
    assert [r.id for r in held] == [r.id for r in blocks] and len(held) == 80
    assert np.allclose([(r.x, r.y) for r in held], [(r.x, r.y) for r in blocks], atol=1e-6)
