"""Road graphs of simple skeletons."""

from __future__ import annotations

import pytest

from lumenfold.operators import roads as R


def cross():
    return {(x, 0) for x in range(-8, 9)} | {(0, y) for y in range(-8, 3)}


def test_cross_and_spur():
    nodes, edges = R.trace(cross())
    assert sorted(nodes.values()) == ["endpoint"] * 4 + ["junction"] and len(edges) == 4
    kept = R.pruned(cross(), 4.0)
    nodes, edges = R.trace(kept)
    assert sorted(nodes.values()) == ["endpoint"] * 3 + ["junction"] and len(edges) == 3
    assert all(7 <= R.length_of(p) <= 8 for _, _, p in edges)


def test_corner_is_no_junction():
    nodes, edges = R.trace({(0, 0), (1, 0), (2, 0), (2, 1), (2, 2)})
    assert sorted(nodes.values()) == ["endpoint", "endpoint"] and len(edges) == 1 and R.length_of(edges[0][2]) == pytest.approx(4)


def test_edges_by_raster(spark):
    rows = [(k, x, y) for k in (1, 2) for x, y in cross()]
    found = R.road_edges(spark.createDataFrame(rows, "k int, x long, y long"), "k", shortest=4.0).collect()
    assert sorted(r.k for r in found) == [1, 1, 1, 2, 2, 2]
