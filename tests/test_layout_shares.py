"""The layout where tasks push the nodes of their shares of groups of cells."""

import numpy as np
import pytest

from quillgraph.operators import layout
from test_graph import all_pairs, cells_of, planted


def test_iterations_over_65536_nodes_write_no_tables(spark, monkeypatch):
    """Graphs of more nodes than the table of cells may have took three jobs with shuffles and a table an iteration."""
    written, settle = [], layout.settle
    monkeypatch.setattr(layout, "settle", lambda df: written.append(1) or settle(df))
    edges = spark.range(70_000).selectExpr("id AS a", "(id * 7 + 1) % 70000 AS b", "1.0D AS weight")
    assert layout.force_layout(edges, 3).count() == 70_000 and len(written) <= 4


def test_shares_are_all_groups_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    at, mass = np.r_[rng.normal(size=(900, 2)), np.full((60, 2), 0.3)], np.ones(960)
    cells = layout._cells(at, mass)
    shares = [layout._share(cells, at, k, 5) for k in range(5)]
    assert sorted(np.concatenate(shares).tolist()) == list(range(960))
    whole = layout.repulsion(cells, np.arange(960), at, mass, 0.5)
    assert all(np.allclose(layout.repulsion(cells, x, at, mass, 0.5), whole[x]) for x in shares)
    a, b, w = planted(80, 4, np.random.default_rng(5))
    edges = spark.createDataFrame([(f"n{x:02}", f"n{y:02}", float(z)) for x, y, z in zip(a, b, w, strict=True)], "a string, b string, weight double")
    rows = lambda: np.array([(r.x, r.y) for r in sorted(layout.force_layout(edges, 6).collect())])
    one = rows()
    monkeypatch.setattr(layout, "TASK", 20)
    assert np.allclose(rows(), one, atol=1e-6)


@pytest.mark.parametrize("most", [1, 50, 1 << 14])
def test_crowded_cells_in_steps(most):
    rng = np.random.default_rng(6)
    at, mass = np.r_[rng.normal(size=(100, 2)) * 300, rng.normal(size=(300, 2)) * 1e-3, np.full((50, 2), 7.0)], rng.integers(1, 9, 450) + 0.0
    exact, scale = all_pairs(at, mass)
    cells = cells_of(at, mass, 3)
    assert np.allclose(layout.repulsion(cells, np.arange(450), at, mass, 1e-6, most=most), exact)
    near = layout.repulsion(cells, np.arange(450), at, mass, 0.5, most=most)
    assert (np.hypot(*(near - exact).T) <= 0.25 * scale).all()
    assert layout.repulsion(cells, np.arange(0), at, mass, 0.5).shape == (0, 2)
