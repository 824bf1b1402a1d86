"""Operators on small frames with hand-computed or brute-force results."""

from __future__ import annotations

import itertools
import random
from collections import Counter
from unittest import mock

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lumenfold.functions import answers as A
from lumenfold.functions.assignment import assign
from lumenfold.operators import evaluation as E
from lumenfold.operators import repetition as R
from lumenfold.operators import spatial as S
from lumenfold.operators import votes as V


def test_vote_takes_lowest_instance_on_ties_and_skips_scores_up_to_zero(spark):
    rows = spark.createDataFrame([(1, 5, 2.0), (1, 3, 2.0), (1, 9, -4.0), (2, 7, 0.0)], "p int, i int, s double")
    assert [tuple(r) for r in V.weighted_vote(rows, "p", "i", "s").collect()] == [(1, 3, 0.5)]


def test_assignment_matches_all_permutations():
    rng = random.Random(3)
    for _ in range(300):
        n, m = rng.randint(1, 5), rng.randint(1, 6)
        cost = np.array([[rng.randint(-9, 9) for _ in range(m)] for _ in range(n)], dtype=float)
        small, large = min(n, m), max(n, m)
        grid = cost if n <= m else cost.T
        best = min(sum(grid[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        found = assign(cost)
        assert len(found) == small
        assert sum(cost[r, c] for r, c in found) == best


def test_dbscan_matches_brute_force(spark):
    rng = random.Random(5)
    points = [(k, rng.uniform(0, 10), rng.uniform(0, 10)) for k in range(120)]
    eps, least = 1.0, 4
    near = {a: [b for b, x2, y2 in points if (x - x2) ** 2 + (y - y2) ** 2 <= eps * eps] for a, x, y in points}
    core = {a for a in near if len(near[a]) >= least}
    label = {a: a for a in core}
    changed = True
    while changed:
        changed = False
        for a in core:
            low = min(label[b] for b in near[a] if b in core)
            if low < label[a]:
                label[a], changed = low, True
    want = {a: label[a] if a in core else min((label[b] for b in near[a] if b in core), default=-1) for a in near}
    df = spark.createDataFrame(points, "id long, x double, y double")
    assert {r.id: r.cluster for r in S.dbscan(df, ["x", "y"], "id", eps, least).collect()} == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 200)] + [(500, 501)], "a long, b long")
    found = {r.node: r.root for r in S.components(edges).collect()}
    assert set(found[k] for k in range(1, 201)) == {1} and found[501] == 500


def test_nms_keeps_at_the_limit(spark):
    boxes = spark.createDataFrame([(1, 1, 0.9, 0.0, 0.0, 2.0, 1.0), (1, 2, 0.8, 1.0, 0.0, 3.0, 1.0), (1, 3, 0.7, 0.1, 0.0, 2.0, 1.0)], "img int, id int, s double, x1 double, y1 double, x2 double, y2 double")
    box = ["x1", "y1", "x2", "y2"]
    assert sorted(r.id for r in E.greedy_keep(boxes, ["img"], "id", "s", box, 1 / 3).collect()) == [1, 2]


def test_hota_of_perfect_tracks_is_one(spark):
    rows = spark.createDataFrame(pd.DataFrame([{"seq": "a", "t": t, "gt": g, "trk": 10 + g, "sim": 1.0} for t in range(4) for g in range(3)]))
    assert {round(r.hota, 9) for r in E.hota(rows, ["seq"]).collect()} == {1.0}


def test_answer_functions(spark):
    row = spark.createDataFrame([("", "", "x^2 \\boxed{a{b}c}", "b, A;c", "c and a, B", "1,000", "1000.05")], "e1 string, e2 string, box string, l1 string, l2 string, n1 string, n2 string")
    got = row.select(
        A.edit_similarity("e1", "e2"), A.boxed("box"), A.list_equal(F.col("l1"), F.col("l2")), A.number_equal(F.col("n1"), F.col("n2")), A.lcs_ratio("e1", "e2"), A.year_exact(F.lit("1999"), F.lit("2000"))
    ).first()
    assert tuple(got) == (0.0, "a{b}c", True, True, 1.0, False)


def test_groups_that_cross_arrow_batches(spark):
    from lumenfold.operators.grouped import each_group

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = spark.createDataFrame([(k, k * 10 + j) for k in range(7) for j in range(k)], "k long, v long")
        total = lambda c: {"total": np.array([c["v"].sum()]), "n": np.array([len(c["v"])])}
        got = {r.k: (r.total, r.n) for r in each_group(rows, ["k"], ["v"], total, "k long, total long, n long").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {k: (sum(k * 10 + j for j in range(k)), k) for k in range(1, 7)}


def test_repeated_windows_make_no_rows(spark):
    """Texts of their own id are counted in place; shared and null ids over all of their texts, long ones by aggregation."""
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("ab ü") for _ in range(rng.randrange(0, 60)))) for k in (*range(40), *range(30, 40), *[None] * 3, *[90] * 5)] + [(50, None), (51, "\U0001f600" * 13)]
    counts = {}
    for k, text in rows:
        for i in range(len(text or "") - 3):
            counts.setdefault(k, Counter())[text[i : i + 4]] += 1
    want = {k: max(c.values()) for k, c in counts.items()}
    for most in (R.GATHERED, 130):
        with mock.patch.object(R, "GATHERED", most):
            assert dict(map(tuple, R.most_repeated(spark.createDataFrame(rows, "id long, text string"), "id", "text", 4).collect())) == want
    once = R.most_repeated(spark.createDataFrame(rows[:30], "id long, text string"), "id", "text", 4)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    for width in (1, 3, 10):
        texts = ["".join(rng.choice(["abcabc", "".join(map(chr, range(0x4E00, 0x9000)))]) for _ in range(3)) for _ in range(2)]
        assert R.most_frequent(texts, width) == max(Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1)).values())


def test_nearest_where_places_are_dense(spark):
    """As many pairs as places, not as their square; ties, places of several rows and far points are as by brute force."""
    rng = random.Random(6)
    spots = [(rng.randrange(400) / 20, float(rng.randrange(12))) for _ in range(900)]
    left = [(k, *rng.choice(spots)) if k % 2 else (k, rng.randrange(-100, 500) / 20, rng.randrange(120) / 10) for k in range(600)] + [(7, 1.0, 1.0), (900, None, 2.0), (901, 500.0, 500.0)]
    right = [(k, *s) for k, s in enumerate(spots)] + [(1000 + k, *s) for k, s in enumerate(spots)] + [(3000, 30.0, 3.0), (3001, None, 1.0)]
    want = {}
    for k, x, y in left:
        near = [((x - a) ** 2 + (y - b) ** 2, m) for m, a, b in right if None not in (x, a)]
        if near and min(near)[0] <= 25.0:
            want[k] = min(want.get(k, min(near)), min(near))
    made = []
    plain = S.within_radius

    def counted(*args):
        pairs = plain(*args)
        made.append(pairs.count())
        return pairs

    frames = spark.createDataFrame(left, "id long, x double, y double"), spark.createDataFrame(right, "other long, x double, y double")
    with mock.patch.object(S, "within_radius", counted):
        got = {r.id: (r.dist2, r.other) for r in S.nearest(*frames, ["x", "y"], "id", "other", 5.0).collect()}
    assert got == want
    assert len(made) > 1 and sum(made) < 20 * len(left), made
