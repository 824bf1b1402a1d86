"""Fits, folds and raster morphology on shapes with known answers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lumenfold.operators import refine as R


def test_circle_fit_and_degenerate_group(spark):
    rows = [("c", 5 + 2 * math.cos(t), -3 + 2 * math.sin(t)) for t in np.linspace(0, 4, 25)] + [("l", float(k), float(k)) for k in range(9)]
    got = {r.g: r for r in R.fit_circles(spark.createDataFrame(rows, "g string, x double, y double"), "g", "x", "y").collect()}
    assert (got["c"].cx, got["c"].cy, got["c"].radius) == (pytest.approx(5), pytest.approx(-3), pytest.approx(2))
    assert got["l"].radius is None


def test_guarded_heights(spark):
    rows = [("a", k, h) for k, h in enumerate([1.0, 1.5, 9.0, 1.2, None, 1.3])]
    assert R.guarded_heights(spark.createDataFrame(rows, "k string, o int, h double"), "k", "o", "h", 1.0).first().heights == [1.0, 1.5, 1.5, 1.2, 1.2, 1.3]


def test_best_annotator(spark):
    rows = [(1, 0, 0.5), (1, 1, 0.5), (1, 2, 0.7), (2, 0, 0.9), (2, 1, None), (3, 0, None), (3, 1, 0.4)]
    got = {r.i: r.best for r in R.best_annotator(spark.createDataFrame(rows, "i int, a int, f double"), "i", "a", "f").collect()}
    assert got == {1: 2, 2: 1, 3: 0}


def test_fixpoint_merge_grows(spark):
    rows = [(1, 0.0, 0.0, 4.0, 1.0, 0.9), (1, 1.0, 0.0, 5.0, 1.0, 0.8), (1, 2.5, 0.0, 6.5, 1.0, 0.7), (1, 50.0, 0.0, 51.0, 1.0, 0.6)]
    got = R.merge_boxes_to_fixpoint(spark.createDataFrame(rows, "g int, a double, b double, c double, d double, s double"), "g", ["a", "b", "c", "d"], "s", 0.3).collect()
    assert sorted((r.a, r.c, r.s, r.n) for r in got) == [(0.0, 6.5, 0.9, 3), (50.0, 51.0, 0.6, 1)]


def test_rotated_iou(spark):
    rows = [(1, 0.0, 0.0, 2.0, 2.0, 0.0, 0.0, 0.0, 2.0, 2.0, 90.0), (2, 0.0, 0.0, 2.0, 2.0, 0.0, 1.0, 0.0, 2.0, 2.0, 0.0), (3, 0.0, 0.0, 2.0, 2.0, 0.0, 9.0, 0.0, 2.0, 2.0, 30.0)]
    names = [f"a{k}" for k in range(5)], [f"b{k}" for k in range(5)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} double" for side in names for n in side))
    got = {r.i: r.iou for r in R.rotated_iou(df, *names, ["i"]).collect()}
    assert got == {1: pytest.approx(1), 2: pytest.approx(1 / 3), 3: 0.0}


def test_thin_and_distance(spark):
    mask = np.zeros((12, 30), dtype=bool)
    mask[3:8, 2:28] = True
    line = R.thin(mask)
    assert 15 <= line.sum() <= 30 and (line.sum(axis=0) <= 2).all()
    ys, xs = np.nonzero(~mask)
    want = np.array([[np.sqrt(((ys - y) ** 2 + (xs - x) ** 2).min()) if mask[y, x] else 0 for x in range(30)] for y in range(12)])
    assert np.allclose(R.distance_map(mask), want)
    rows = [(1, int(x), int(y)) for y, x in np.argwhere(mask)]
    got = R.per_raster(spark.createDataFrame(rows, "k int, x long, y long"), "k", "x", "y", "distance").collect()
    assert len(got) == mask.sum() and max(r.value for r in got) == 3.0
