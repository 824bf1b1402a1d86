"""De-duplication operators against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.llm import order_minhash
from lumenfold.llm.alignment import edit_distance
from lumenfold.llm.line_templates import dedup_lines
from lumenfold.llm.order_minhash import common_of, near_duplicates, without_near_duplicates
from lumenfold.llm.store import AT_END, Cuts
from lumenfold.llm.substring_dedup import substring_dedup
from lumenfold.llm.suffix_dedup import intervals, maximal_repeats, suffix_dedup

SCHEMA = "doc_id long, text string, _text string, n_words int"  # with names that the operators use, too


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)


def texts_with_repeats(seed, count=40):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(200)) for _ in range(3)]
    rows = []
    for d in range(count):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["é", "zz"])
        a = rng.randrange(60)
        rows.append((d * 7 % 41, " ".join(words[a : a + rng.randint(5, 150)])))
    return [*rows, (90, None), (91, ""), (92, " \t\n"), rows[0]]


def brute_words(rows, window):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window", [12, 50])
def test_substring_dedup(spark, window):
    rows = texts_with_repeats(window)
    found = substring_dedup(frame(spark, rows), window).select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert sorted(tuple(r) for r in found.collect()) == brute_words(rows, window)


def test_substring_dedup_long_text_and_null_id(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(None, long), (1, long), (2, "w1")]
    got = {r.doc_id: r.n_removed for r in substring_dedup(frame(spark, rows)).collect()}
    assert got == {None: 60_000, 1: 0, 2: 0}


def brute_bytes(rows, length):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode()
        for i in range(len(w) - length + 1):
            first.setdefault(w[i : i + length], (d, i))
    out = []
    for d, t in rows:
        w = (t or "").encode()
        gone = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if first[w[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(w), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("length", "limit"), [(30, 50_000), (30, 3), (100, 50_000)])
def test_suffix_dedup(spark, length, limit):
    rows = texts_with_repeats(length)
    rows = [(d, t and t + "ab" * (d % 70) + t[: d % 50]) for d, t in rows]
    found = suffix_dedup(frame(spark, rows), length, group_limit=limit).select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long"), F.sha2("kept", 256))
    assert sorted(tuple(r) for r in found.collect()) == brute_bytes(rows, length)


def test_intervals_and_maximal_repeats():
    assert sorted(intervals([0, 3, 3, 1], 4)) == [(1, 0, 3), (3, 0, 2)]
    # xANCHORy, xANCHORz, wANCHORy: the pairs (x, ANCHOR) and (ANCHORy) and all three
    found = list(maximal_repeats([b"x", b"x", b"w"], [b"ANCHORy", b"ANCHORz", b"ANCHORy"], [(0,), (1,), (2,)], 6))
    assert sorted((l, r, sorted(m)) for l, r, m, _ in found) == [(0, 6, [0, 1, 2]), (0, 7, [0, 2]), (1, 6, [0, 1])]


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup, near_duplicates, dedup_lines])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        b = [x if rng.random() < 0.8 else rng.randrange(4) for x in a] if rng.random() < 0.5 else [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        limit = rng.randint(0, 10)
        assert edit_distance(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), limit) == min(brute_edits(a, b), limit + 1)


def test_near_duplicates(spark):
    rng = random.Random(2)
    rows, base = [], [[f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))] for _ in range(12)]
    notice = "all rights of this shared notice are reserved by us".split()
    for d in range(120):
        words = list(base[rng.randrange(12)]) if d % 3 else [f"u{d}x{k}" for k in range(40)] + notice
        for _ in range(rng.randint(0, len(words) // 12)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(100)}"
        rows.append((d, " ".join(words)))
    rows += [(200, rows[1][1].upper()), (201, None), (202, ""), (203, "one two"), (204, "one two"), (205, None), rows[1]]
    words = {d: (t or "").lower().split() for d, t in rows}
    parent = {d: d for d in words}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(words)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            m = max(len(words[a]), len(words[b]))
            if words[a] and words[b] and abs(len(words[a]) - len(words[b])) <= 0.2 * m and brute_edits(words[a], words[b]) <= 0.2 * m:
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    groups = defaultdict(list)
    for d in ids:
        groups[root(d)].append(d)
    want = {d: min(g) for g in groups.values() for d in g}
    found = near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.class_id for r in found} == want


def test_line_templates(spark):
    rng = random.Random(4)
    own = lambda: " ".join(f"w{rng.randrange(3000)}x" for _ in range(9))
    rows = [(d, "\n".join([own(), f"Page {d} of 40 printed here", own(), "", own()])) for d in range(30)]
    page = "\n".join(own().replace("w", "q") for _ in range(5))
    rows += [(100 + k, page) for k in range(30)]  # copies of one page are no boilerplate
    rows += [(200, None), (201, ""), (202, "\n\n")]
    got = {r.doc_id: r for r in dedup_lines(frame(spark, rows)).collect()}
    texts = dict(rows)
    for d in range(30):
        lines = texts[d].split("\n")
        assert got[d].text == "\n".join(x for x in lines if not x.startswith("Page")) and got[d].n_dropped == 1 and got[d].n_lines == 5
    assert all(got[100 + k].text == page for k in range(30))
    assert got[200].text is None and got[201].text == "" and got[202].text == "\n\n"
    assert set(got[0].asDict()) == {"doc_id", "text", "_text", "n_words", "n_lines", "n_dropped"}


def test_near_duplicates_around_a_common_passage(spark):
    rng = random.Random(8)
    passage = [f"p{k}" for k in range(70)]
    rows, want = [], {}
    for d in range(120):
        words = [f"u{d}x{k}" for k in range(30)] + passage + [f"v{d}x{k}" for k in range(30)]
        rows.append((d, " ".join(words)))
        want[d] = d
        if d % 6 == 0:  # a copy with single words changed
            for _ in range(6):
                words[rng.randrange(len(words))] = f"e{rng.randrange(999)}"
            rows.append((1000 + d, " ".join(words)))
            want[1000 + d] = d
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == want


def changed(words, share, rng, tag, lo=0):
    words = list(words)
    for i in rng.sample(range(lo, len(words)), round(share * len(words))):
        words[i] = f"{tag}{i}"
    return words


def test_near_duplicates_in_a_crowded_bucket(spark):
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(300)]
    rows, want = [], {}
    for d in range(60):  # half a common passage; a near copy differs in its own half
        words = passage + [f"u{d}x{k}" for k in range(300)]
        rows += [(d, " ".join(words)), (1000 + d, " ".join(changed(words, 110 / 600, rng, f"e{d}x", 300)))]
        want |= {d: d, 1000 + d: d}
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == want


def test_near_duplicates_through_an_explained_member(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for g in range(4):
        a = [f"g{g}w{k}" for k in range(400)]
        far = changed(a, 0.17, rng, f"b{g}x")
        rows += [(1000 * g + d, " ".join(changed(a, 0.1, rng, f"l{g}x{d}x"))) for d in range(50)]
        rows += [(1000 * g + 500, " ".join(a)), (1000 * g + 501, " ".join(far))]
        want |= {d: 1000 * g for d, _ in rows if d >= 1000 * g}
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == want


def test_near_duplicates_tell_apart_texts_of_one_id(spark):
    rng = random.Random(13)
    one, two = [[f"{c}{k}" for k in range(100)] for c in "ab"]
    near = lambda words: " ".join(changed(words, 0.05, rng, "e"))
    rows = [(3, " ".join(one)), (9, " ".join(two)), (None, near(one)), (None, near(two)), (20, near(one)), (20, " ".join(f"c{k}" for k in range(100)))]
    got = sorted((r.doc_id or 0, r.class_id, r.class_size) for r in near_duplicates(frame(spark, rows)).collect())
    assert got == [(0, 3, 3), (0, 9, 2), (3, 3, 3), (9, 9, 2), (20, 3, 3), (20, 20, 1)]
    kept = sorted((r.doc_id or 0, r.text) for r in without_near_duplicates(frame(spark, rows)).collect())
    assert kept == sorted((d or 0, t) for d, t in [rows[0], rows[1], rows[2], rows[3], rows[5]])


def notice_pages(lines, own, count, first):
    return [(first + d, "\n".join([f"own{c} of{d} page{c}x{d}".replace("0", "o") + chr(97 + d % 26) * (d // 26 + 1) for c in range(own)] + [f"notice line {'abcdefghijklmnopqrstuvwxyz'[k] * 3} stands here" for k in range(lines)])) for d in range(count)]


@pytest.mark.parametrize(("own", "lines"), [(1, 3), (2, 5), (5, 20)])
def test_notice_of_several_lines(spark, own, lines):
    rows = notice_pages(lines, own, 100, 0)
    assert {r.n_dropped for r in dedup_lines(frame(spark, rows)).collect()} == {lines}


def test_copies_elsewhere_do_not_protect_a_notice(spark):
    rows = notice_pages(1, 4, 100, 0)
    page = [f"passage {chr(97 + k) * 4} of the copied page" for k in range(12)] + [rows[0][1].split("\n")[-1]]
    for d in range(400):
        rows.append((1000 + d, "\n".join([*page, f"changed {chr(97 + d % 26) * (d // 26 + 1)}"])))
    got = {r.doc_id: r.n_dropped for r in dedup_lines(frame(spark, rows)).collect()}
    assert got == {d: 1 for d, _ in rows}


def planted_pairs(share, evenly, rng, count=150, n=120):
    """Pairs of texts of which the second has ``share`` of its words replaced."""
    rows = []
    for d in range(count):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        other = list(words)
        edits = round(share * n)
        for k, i in enumerate([round((k + 0.5) * n / edits) for k in range(edits)] if evenly else rng.sample(range(n), edits)):
            other[min(i, n - 1)] = f"e{d}x{k}"
        rows += [(2 * d, " ".join(words)), (2 * d + 1, " ".join(other))]
    return rows


@pytest.mark.parametrize("evenly", [True, False])
def test_recall_of_planted_pairs(spark, evenly):
    rng = random.Random(21)
    shares, rows = [0.1, 0.125, 1 / 6, 0.2], []
    for k, share in enumerate(shares):
        rows += [(10_000 * k + d, t) for d, t in planted_pairs(share, evenly, rng)]
    got = {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()}
    for k, least in enumerate([150, 150, 145, 135]):
        own = range(10_000 * k, 10_000 * k + 300, 2)
        assert sum(got[d] == got[d + 1] for d in own) >= least, shares[k]
    assert len(set(got.values())) >= 600


def test_common_of():
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 9000, rng.integers(0, 6000))).astype(np.uint32) for _ in range(k)] for k in (5, 7))
    assert (common_of(left, right) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()
    assert common_of([], []).shape == (0, 0)


@pytest.mark.parametrize("block", [8, 256])
def test_near_duplicates_in_blocks(spark, block, monkeypatch):
    """Texts that are mostly one passage stay crowded to the end; each link between them is found."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    rng = random.Random(22)
    passage, rows, want = [f"p{k}" for k in range(78)], [], {}
    for d in range(60):
        own = [f"u{d}x{k}" for k in range(22)]
        rows += [(d, " ".join(passage + own)), (1000 + d, " ".join(changed(passage + own, 0.18, rng, f"e{d}x", 78 if d % 2 else 0)))]
        want |= {d: d, 1000 + d: d}
    for d in range(300):  # near copies of one page that holds the passage, too
        rows.append((2000 + d, " ".join(changed(passage + [f"page{k}" for k in range(300)], 0.03, rng, f"m{d}x", 78))))
        want[2000 + d] = 2000
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == want


def test_near_duplicates_by_slices_of_keys(spark, monkeypatch):
    """Keys that are many for the number of texts are worked on slice by slice, with the same classes."""
    seen = {"_mixed": [], "_paired": []}
    for name, at in (("_mixed", 2), ("_paired", 0)):

        def spied(*args, name=name, at=at, run=getattr(order_minhash, name)):
            seen[name].append(args[at].count())
            return run(*args)

        monkeypatch.setattr(order_minhash, name, spied)
    rng = random.Random(25)
    passage, rows, want = [f"p{k}" for k in range(78)], [], {}
    for d in range(60):
        own = [f"u{d}x{k}" for k in range(22)]
        rows += [(d, " ".join(passage + own)), (1000 + d, " ".join(changed(passage + own, 0.18, rng, f"e{d}x", 78 if d % 2 else 0)))]
        want |= {d: d, 1000 + d: d}
    for value, name in ((200, "PLAIN_ROWS"), (2, "BINNED_ROWS"), (-110, "SPARE")):
        monkeypatch.setattr(order_minhash, name, value)
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == want
    assert all(len(counts) > 3 for counts in seen.values()), seen
    assert max(seen["_mixed"]) < 2 * 200 * 10 and max(seen["_paired"]) < 2 * 2 * 10, seen


def test_blocks_by_slices_of_keys(spark):
    rows = [(key, node, node % 30, 100, 0, 40, 50) for key in range(12) for node in range(key, key + 50)]
    hot = spark.createDataFrame(rows, "_key long, _node long, _class long, _n int, _main long, _rest long, _all long")
    held = [(n, bytes(np.arange(100, dtype=np.uint32)), [k for k in range(12) if k <= n < k + 50]) for n in range(61)]
    words = spark.createDataFrame(held, "_node long, _words binary, _all_keys array<long>")
    slices, cuts = order_minhash._slices(hot, 600, 300 - order_minhash.SPARE, 0.5), Cuts(spark, "test")
    assert len(slices) == 5
    got = [tuple(r) for r in order_minhash._each(cuts, "blocks", slices, lambda part: order_minhash._in_blocks(part, words, 0.8)).collect()]
    assert sorted(got) == [(a, b) for a in range(61) for b in range(a) if a % 30 != b % 30 and a - b < 50]
    cuts.drop(*list(cuts.paths))


def test_no_shuffle_files_stay_behind_a_table(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    cuts = Cuts(spark, "test")
    found = spark.conf.get(AT_END)
    table = cuts.put("counts", spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.monotonic() + 5
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(AT_END) == found and table.count() == 7
    cuts.drop("counts")


def test_pairs_leave_blocks_under_one_key(spark, monkeypatch):
    """Nodes share many keys; every pair across classes comes out, and once."""
    monkeypatch.setattr(order_minhash, "BLOCK", 8)
    rng = random.Random(24)
    held = {node: rng.sample(range(-6, 6), rng.randrange(1, 9)) for node in range(70)}
    kind = {node: node % 40 for node in held}
    rows = []
    for key in range(-6, 6):
        inside = [node for node, keys in held.items() if key in keys]
        sizes = Counter(kind[node] for node in inside)
        main = max(sizes, key=lambda c: (sizes[c], c))
        rows += [(key, node, kind[node], 100, main, len(inside) - sizes[main], len(inside)) for node in inside]
    hot = spark.createDataFrame(rows, "_key long, _node long, _class long, _n int, _main long, _rest long, _all long")
    words = spark.createDataFrame([(n, bytes(np.arange(100, dtype=np.uint32)), k) for n, k in held.items()], "_node long, _words binary, _all_keys array<long>")
    got = [tuple(r) for r in order_minhash._in_blocks(hot, words, 0.8).collect()]
    assert sorted(got) == [(a, b) for a in held for b in range(a) if kind[a] != kind[b] and set(held[a]) & set(held[b])]


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup, near_duplicates, dedup_lines])
def test_ids_that_are_no_numbers_are_refused(spark, operator):
    with pytest.raises(TypeError):
        operator(spark.createDataFrame([("a", "text")], "doc_id string, text string"))


def test_near_duplicates_of_very_long_texts(spark):
    rng = random.Random(23)
    long = [f"w{rng.randrange(10**6)}" for _ in range(30_000)]
    rows = [(1, " ".join(long)), (2, " ".join(changed(long, 0.1, rng, "e"))), (3, " ".join(long[:20_000]))]
    assert {r.doc_id: r.class_id for r in near_duplicates(frame(spark, rows)).collect()} == {1: 1, 2: 1, 3: 3}
