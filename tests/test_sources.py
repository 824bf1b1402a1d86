"""Data sources: round trips and tolerant parsing."""

from __future__ import annotations

import json

import numpy as np
import pytest

from lumenfold.sources import text as X


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    X.register(spark)


def test_las_round_trip_by_ranges(spark, tmp_path):
    points = spark.range(1000).selectExpr("CAST(id * 0.25 AS DOUBLE) AS x", "CAST(-id AS DOUBLE) AS y", "2.5D AS z", "CAST(id % 256 AS SHORT) AS r", "CAST(1 AS SHORT) AS g", "CAST(2 AS SHORT) AS b", "CAST(id % 200 AS SHORT) AS intensity")
    path = str(tmp_path / "cloud")
    points.coalesce(2).write.format("las").mode("append").save(path)
    found = spark.read.format("las").option("recordsPerPartition", 100).load(path)
    assert found.rdd.getNumPartitions() >= 10
    got = sorted((round(r.x, 3), round(r.y, 3), r.z, r.r, r.b, r.intensity) for r in found.collect())
    assert got == sorted((k * 0.25, float(-k), 2.5, k % 256, 2, k % 200) for k in range(1000))


def test_ply_ascii_and_binary(spark, tmp_path):
    head = "ply\nformat {}\nelement vertex 2\nproperty float x\nproperty uchar red\nend_header\n"
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.ply").write_text(head.format("ascii 1.0") + "0.5 7\n1.5 255\n")
    data = np.array([(0.5, 7), (1.5, 255)], dtype=[("x", "<f4"), ("r", "u1")]).tobytes()
    (tmp_path / "a" / "two.ply").write_bytes(head.format("binary_little_endian 1.0").encode() + data)
    rows = spark.read.format("ply").load(str(tmp_path / "a")).collect()
    assert sorted((r.pid, r.x, r.red) for r in rows) == [(0, 0.5, 7), (0, 0.5, 7), (1, 1.5, 255), (1, 1.5, 255)]


def test_npz_with_missing_keys(spark, tmp_path):
    np.savez(tmp_path / "a.npz", scores=np.array([0.5, 0.25]), boxes=np.arange(8).reshape(2, 4))
    np.savez(tmp_path / "b.npz", scores=np.array([1.0]))
    rows = spark.read.format("npz").option("keys", "scores,boxes").load(str(tmp_path)).collect()
    assert sorted((r.stem, r.row, r.scores, r.boxes) for r in rows) == [("a", 0, [0.5], [0.0, 1.0, 2.0, 3.0]), ("a", 1, [0.25], [4.0, 5.0, 6.0, 7.0]), ("b", 0, [1.0], None)]


def test_text_formats(spark, tmp_path):
    (tmp_path / "m.obj").write_text("v 0 0 0\nv 1 0 0\n# c\nl 1 2\n")
    v, e = X.read_obj(spark, str(tmp_path / "m.obj"))
    assert v.count() == 2 and [tuple(r) for r in e.collect()] == [(0, 1)]
    (tmp_path / "p.txt").write_text("name x y z\na.las 1 2 3\nshort 1\nb.las 4 5 6 7\n")
    assert sorted(tuple(r) for r in X.read_positions(spark, str(tmp_path / "p.txt")).collect()) == [("a.las", 1.0, 2.0, 3.0), ("b.las", 4.0, 5.0, 6.0)]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "img1.txt").write_text("tree\t0.5\npole\ntree\t0.75\ntree\t0.75\n\n")
    assert sorted(tuple(r) for r in X.read_responses(spark, str(tmp_path / "r")).collect()) == [("img1", "pole", 1.0, 1), ("img1", "tree", 0.75, 2)]
    doc = {"images": [{"id": 1}, {"id": 2}], "annotations": [{"id": 5, "image_id": 1, "area": 2.0}], "categories": []}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    assert {r.id: len(r.annotations) for r in X.read_coco(spark, str(tmp_path / "c.json")).collect()} == {1: 1, 2: 0}
    (tmp_path / "t.csv").write_text("1,3,0,0,1,1,0.5\n1,-1,0,0,1,1,0.5\n")
    assert [r.id for r in X.read_tracks(spark, str(tmp_path / "t.csv")).collect()] == [3]


def test_instance_boxes_number_their_vertices(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (1, 1.0, 2.0, 3.0), (2, 5.0, 5.0, 5.0)], "i int, x double, y double, z double")
    rows = {r.i: r.obj.split("\n") for r in X.instance_boxes(points, "i").collect()}
    assert all(len([x for x in r if x.startswith("v ")]) == 8 and len([x for x in r if x.startswith("l ")]) == 12 for r in rows.values())
    assert "v 1.0 2.0 3.0" in rows[1] and "l 9 10" in rows[2]
