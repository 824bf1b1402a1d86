"""Exact byte-level de-duplication from the common-prefix interval tree of a sparse suffix array.

A document loses each byte covered by a string of ``length`` bytes that also starts
earlier: in a document of smaller id, or further to the left in the same document.

* **Anchors.**  Each ``length``-byte window is represented by the leftmost of its
  smallest hashed ``GRAM``-byte substrings.  Equal windows have equal anchors at
  equal offsets, so only suffixes that start at an anchor need to be sorted, and
  only anchors whose gram occurs more than once in the corpus.
* **Copies.**  A text that a smaller id has, too, is removed whole at the start.
* **Slices.**  An anchor's slice is the text of all windows that it represents.
  Identical slices are combined first, within a document and then by an aggregation:
  all but the earliest are removed whole.  What differs goes on.
* **Enhanced suffix array.**  The anchored suffixes of a partition are sorted with
  their common-prefix lengths, and a stack scan of those yields the interval tree.
  An interval of depth ``r`` is a set of occurrences that share ``r`` bytes to the
  right.  Its members are merged in order of falling common length ``l`` to the
  left: wherever the left extensions diverge, the members on either side form a
  maximal repeat of ``l + r`` bytes, and all its occurrences but the earliest are
  removed if ``l + r`` reaches ``length``.
* **Hot anchors.**  An anchor with more than ``group_limit`` different slices is
  not gathered in one task.  Its windows are compared by a distributed aggregation
  on 128-bit keys instead, with the same result.

Defined cases: a null text is empty; a null id counts as larger than all others;
rows repeated with one id and text are one document in two copies, neither of which
is earlier; texts shorter than ``length`` keep all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rolling import BYTE_BASE, U64, byte_hash, byte_prefix, mix, powers, sliding, text_runs
from .store import Cuts
from .substring_dedup import exact_copies, keyed, listed, of_documents, owner
from .worker import frugal

GRAM = 20
#: Bytes of text worked on at once: arrays of this many 64-bit numbers stay near the caches.
RUN = 1 << 18
SLICE_COLUMNS = ["_key", "_s1", "_s2", "_ord", "_tkey", "_pos", "_left", "_slice"]
SECOND_BASE = 0xC2B2AE3D27D4EB4F
_SECOND_VALUES = mix(np.arange(1001, 1257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def _grams(data: np.ndarray) -> np.ndarray:
    at = np.arange(max(0, len(data) - GRAM + 1))
    return byte_hash(byte_prefix(data), at, at + GRAM)


def _windows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, the smallest one in the window from each byte, and which of those windows lie in one text."""
    grams = _grams(data)
    best = sliding(grams, length - GRAM + 1, np.minimum)
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(best)]
    return grams, best, np.arange(len(best)) + length <= end


def _anchor_keys(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each document's distinct anchor hashes, and whether one stands at several places in it."""
    width = length - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, tkeys = of_documents(batch.column("_ord")), of_documents(batch.column("_tkey"))
            for i, j, data, offsets in text_runs(batch.column("_text"), RUN):
                if len(data) < length:
                    continue
                grams, best, whole = _windows(data, offsets, length)
                top = np.concatenate([np.zeros(width - 1, U64), np.where(whole, best, U64(0)), np.zeros(width - 1, U64)])
                at = np.flatnonzero(sliding(top, width, np.maximum)[: len(grams)] == grams)
                if not len(at):
                    continue
                doc = np.searchsorted(offsets, at, side="right") - 1
                order = np.lexsort((grams[at], doc))
                key, doc = grams[at][order], doc[order]
                new = np.ones(len(key), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(new)
                many = np.diff(np.append(head, len(key))) > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[head].view(np.int64)), pa.array(ords[i:j][doc[head]]), pa.array(tkeys[i:j][doc[head]]), pa.array(many)],
                    ["_key", "_ord", "_tkey", "_many"],
                )

    return frugal(run)


def _slices(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The slices of each document's surviving anchors, and spans that a document's own earlier slices cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, tkeys = of_documents(batch.column("_ord")), of_documents(batch.column("_tkey"))
            values, bounds = listed(batch.column("_alive"))
            for i, j, data, offsets in text_runs(batch.column("_text"), RUN):
                if len(data) < length:
                    continue
                grams, best, whole = _windows(data, offsets, length)
                low = best.view(np.int64)
                alive = []
                for d in range(j - i):
                    a, b = int(offsets[d]), int(offsets[d + 1]) - length + 1
                    if b > a:
                        known = np.sort(values[bounds[i + d] : bounds[i + d + 1]])
                        spot = np.minimum(np.searchsorted(known, low[a:b]), len(known) - 1)
                        alive.append(a + np.flatnonzero(known[spot] == low[a:b]))
                at = np.concatenate(alive) if alive else np.zeros(0, np.int64)
                if not len(at):
                    continue
                anchor = leftmost(grams, np.where(whole, best, U64(0)), at, length - GRAM + 1)
                new = np.ones(len(at), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(at)) - 1
                lo, hi, mid = at[head], at[tail] + length, anchor[head]
                doc = np.searchsorted(offsets, lo, side="right") - 1
                p, q = _prefixes(data)
                s1 = _range_hash(p, BYTE_BASE, lo, hi).view(np.int64)
                s2 = _range_hash(q, SECOND_BASE, lo, hi).view(np.int64)
                order = np.lexsort((s2, s1, doc))  # stable: the leftmost of equal slices comes first
                x, y = order[1:], order[:-1]
                copy = np.zeros(len(lo), dtype=bool)
                copy[x[(doc[x] == doc[y]) & (s1[x] == s1[y]) & (s2[x] == s2[y])]] = True
                if copy.any():
                    yield _own_copies(lo[copy], hi[copy], doc[copy], offsets, ords[i:j], tkeys[i:j])
                k = np.flatnonzero(~copy)
                lo, hi, mid, doc = lo[k], hi[k], mid[k], doc[k]
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low[lo]),
                        pa.array(s1[k]),
                        pa.array(s2[k]),
                        pa.array(ords[i:j][doc]),
                        pa.array(tkeys[i:j][doc]),
                        pa.array((lo - offsets[doc]).astype(np.int32)),
                        pa.array((mid - lo).astype(np.int32)),
                        pa.array([raw[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary()),
                    ],
                    SLICE_COLUMNS,
                )

    return frugal(run)


def _own_copies(lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, offsets: np.ndarray, ords: np.ndarray, tkeys: np.ndarray) -> pa.RecordBatch:
    """What slices cover that stand further left in their document, too: spans, with no slice and ``_left`` for the length."""
    first = np.ones(len(lo), dtype=bool)
    first[1:] = (lo[1:] > hi[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(first)
    end = hi[np.append(head[1:], len(lo)) - 1]
    lo, doc = lo[head], doc[head]
    none = pa.nulls(len(head), pa.int64())
    place = [pa.array((lo - offsets[doc]).astype(np.int32)), pa.array((end - lo).astype(np.int32))]
    return pa.RecordBatch.from_arrays([none, none, none, pa.array(ords[doc]), pa.array(tkeys[doc]), *place, pa.nulls(len(head), pa.binary())], SLICE_COLUMNS)


def _prefixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p, _ = powers(SECOND_BASE, len(text) + 1)
    second = np.zeros(len(text) + 1, dtype=U64)
    np.cumsum(_SECOND_VALUES[text] * p[: len(text)], out=second[1:])
    return byte_prefix(text), second


def _range_hash(prefix: np.ndarray, base: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    _, inverse = powers(base, len(prefix) + 1)
    return mix((prefix[hi] - prefix[lo]) * inverse[lo] + (hi - lo).astype(U64))


def leftmost(grams: np.ndarray, best: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """For windows ``at``: the first place in each where its smallest gram stands."""
    places = np.flatnonzero(_is_minimum(grams, best, width))
    order = np.lexsort((places, grams[places]))
    places = places[order]
    # places are grouped by gram; within a group the first one not before the window is the anchor
    group = grams[places]
    start = np.searchsorted(group, best[at], side="left")
    rank = np.zeros(len(places), dtype=np.int64)
    new = np.ones(len(places), dtype=bool)
    new[1:] = group[1:] != group[:-1]
    number = np.cumsum(new) - 1
    rank = number * (len(grams) + 1) + places
    return places[np.searchsorted(rank, number[start] * (len(grams) + 1) + at)]


def _is_minimum(grams: np.ndarray, best: np.ndarray, width: int) -> np.ndarray:
    zeros = np.zeros(width - 1, U64)
    return sliding(np.concatenate([zeros, best, zeros]), width, np.maximum)[: len(grams)] == grams


def intervals(lcp: list[int], n: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of all intervals of a suffix array's interval tree, children first.

    ``lcp[x]`` is the common-prefix length of suffixes ``x - 1`` and ``x``.
    """
    stack: list[tuple[int, int]] = []
    for x in range(1, n + 1):
        depth, first = (lcp[x] if x < n else -1), x - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, x - 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def maximal_repeats(lefts: list[bytes], rights: list[bytes], ranks: list[tuple], length: int) -> Iterator[tuple[int, int, list[int], int]]:
    """(l, r, members, earliest) of the maximal repeats of at least ``length`` bytes around one anchor.

    ``lefts`` are the bytes before the anchor, reversed; ``rights`` those from it on;
    ``ranks`` order the occurrences.  Right-maximal: the members fill an interval of
    depth ``r`` and do not all lie in one child.  Left-maximal: the next bytes to the
    left of its members differ, or one has none.
    """
    n = len(rights)
    order = sorted(range(n), key=rights.__getitem__)
    lcp = [0] + [common_prefix(rights[order[x - 1]], rights[order[x]]) for x in range(1, n)]
    for r, first, last in intervals(lcp, n):
        if r + max(len(lefts[order[x]]) for x in range(first, last + 1)) < length:
            continue
        child = {}
        number = 0
        for x in range(first, last + 1):
            number += x > first and lcp[x] == r
            child[order[x]] = number
        by_left = sorted(child, key=lefts.__getitem__)
        common = [0] + [common_prefix(lefts[by_left[x - 1]], lefts[by_left[x]]) for x in range(1, len(by_left))]
        for l, a, b in intervals(common, len(by_left)):
            if l + r >= length:
                members = by_left[a : b + 1]
                if any(child[m] != child[members[0]] for m in members):
                    yield l, r, members, min(members, key=ranks.__getitem__)


def _spans_of_group(rows: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(ord, tkey, start, end) of what the slices of one anchor lose; rows: (ord, tkey, pos, left, slice)."""
    lefts = [s[:left][::-1] for _, _, _, left, s in rows]
    rights = [s[left:] for _, _, _, left, s in rows]
    ranks = [(o, p + left) for o, _, p, left, _ in rows]
    best: dict[tuple[int, int], int] = {}
    for l, r, members, _ in maximal_repeats(lefts, rights, ranks, length):
        least = min(ranks[m] for m in members)
        for m in members:
            if ranks[m] > least and best.get((m, r), -1) < l:
                best[m, r] = l
    for (m, r), l in best.items():
        o, t, p, left, _ = rows[m]
        yield o, t, p + left - l, p + left + r


def _repeats(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by anchor: one anchor's slices at a time, also where they cross batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        out: list[tuple[int, int, int, int]] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_key", "_ord", "_tkey", "_pos", "_left", "_slice")]
            for k, *row in zip(*columns, strict=True):
                if k != key:
                    if len(rows) > 1:
                        out += _spans_of_group(rows, length)
                    key, rows = k, []
                rows.append(tuple(row))
            if out:
                yield _span_batch(out)
                out = []
        if len(rows) > 1:
            out += _spans_of_group(rows, length)
        if out:
            yield _span_batch(out)

    return frugal(run)


def _span_batch(out: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    o, t, a, b = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(o, pa.int64()), pa.array(t, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], ["_ord", "_tkey", "_start", "_end"]
    )


def _single_windows(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The windows of hot anchors' slices, keyed by 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, tkeys = of_documents(batch.column("_ord")), of_documents(batch.column("_tkey"))
            starts = of_documents(batch.column("_pos")).astype(np.int64)
            for i, j, data, offsets in text_runs(batch.column("_slice")):
                p, q = _prefixes(data)
                end = np.repeat(offsets[1:], np.diff(offsets))
                lo = np.flatnonzero(np.arange(len(data)) + length <= end)
                row = owner(offsets)[lo]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_range_hash(p, BYTE_BASE, lo, lo + length).view(np.int64)),
                        pa.array(_range_hash(q, SECOND_BASE, lo, lo + length).view(np.int64)),
                        pa.array(ords[i:j][row]),
                        pa.array(tkeys[i:j][row]),
                        pa.array((starts[i:j][row] + lo - offsets[row]).astype(np.int32)),
                    ],
                    ["_h1", "_h2", "_ord", "_tkey", "_pos"],
                )

    return frugal(run)


def _removal(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "removed": [], "kept": []}
            for text, cut, copy in zip(batch.column("_text"), batch.column("_cuts"), batch.column("_whole"), strict=True):
                raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                cover = np.zeros(len(raw) + 1, dtype=np.int64)
                if copy.is_valid and len(raw) >= length:
                    cover[[0, -1]] = 1, -1
                elif cut.is_valid:
                    flat = cut.values
                    np.add.at(cover, flat.field("_start").to_numpy(zero_copy_only=False), 1)
                    np.add.at(cover, flat.field("_end").to_numpy(zero_copy_only=False), -1)
                gone = np.cumsum(cover[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["removed"].append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                out["kept"].append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(out["n_bytes"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["removed"], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array(out["kept"], pa.binary()),
                ],
                ["_id", "n_bytes", "n_removed", "removed", "kept"],
            )

    return frugal(run)

SPANS = "_ord long, _tkey long, _start int, _end int"


def suffix_dedup(documents: DataFrame, length: int = 100, group_limit: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: id, n_bytes, n_removed, removed (byte spans) and the kept bytes.

    ``length`` is at least ``GRAM``.  Kept bytes are binary, as a cut may fall inside
    a character.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    cuts = Cuts(documents.sparkSession, "suffix")
    docs = keyed(documents, id_col, text_col)
    copied = cuts.put("copied", exact_copies(docs))
    keys = cuts.put("keys", docs.mapInArrow(_anchor_keys(length), "_key long, _ord long, _tkey long, _many boolean"))
    shared = (
        keys.groupBy("_key").agg(F.min("_tkey").alias("_lo"), F.max("_tkey").alias("_hi"), F.max("_many").alias("_in")).where("_lo < _hi OR _in").select("_key")
    )
    lists = keys.join(cuts.put("shared", shared), "_key").groupBy("_ord", "_tkey").agg(F.collect_set("_key").alias("_alive"))
    alive = cuts.put("alive", lists.join(copied, ["_ord", "_tkey"], "left_anti"))
    cuts.drop("keys", "shared")
    slices = cuts.put(
        "slices",
        docs.join(alive, ["_ord", "_tkey"]).mapInArrow(
            _slices(length), "_key long, _s1 long, _s2 long, _ord long, _tkey long, _pos int, _left int, _slice binary"
        ),
    )
    cuts.drop("alive")
    place = F.struct("_ord", "_pos")
    own = slices.where("_slice IS NULL").select("_ord", "_tkey", F.col("_pos").alias("_start"), (F.col("_pos") + F.col("_left")).alias("_end"))
    slices = slices.where("_slice IS NOT NULL")
    earliest = slices.groupBy("_s1", "_s2").agg(F.min(place).alias("_least"))
    marked = slices.join(cuts.put("earliest", earliest), ["_s1", "_s2"]).withColumn("_copy", F.col("_least") < place)
    marked = cuts.put("marked", marked.drop("_s1", "_s2", "_least"))
    cuts.drop("earliest")
    copies = marked.where("_copy").select("_ord", "_tkey", F.col("_pos").alias("_start"), (F.col("_pos") + F.length("_slice")).alias("_end"))
    sizes = marked.where("NOT _copy").groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    firsts = cuts.put("firsts", marked.where("NOT _copy").drop("_copy").join(sizes, "_key"))
    together = (
        firsts.where(F.col("_n") <= group_limit)
        .repartition("_key")
        .sortWithinPartitions("_key")
        .select("_key", "_ord", "_tkey", "_pos", "_left", "_slice")
        .mapInArrow(_repeats(length), SPANS)
    )
    hot = firsts.where(F.col("_n") > group_limit)
    spans = copies.unionByName(own).unionByName(together)
    if not hot.isEmpty():
        windows = cuts.put(
            "windows",
            hot.select("_ord", "_tkey", "_pos", "_slice").mapInArrow(_single_windows(length), "_h1 long, _h2 long, _ord long, _tkey long, _pos int"),
        )
        first = windows.groupBy("_h1", "_h2").agg(F.min(place).alias("_least"))
        later = windows.join(cuts.put("first", first), ["_h1", "_h2"]).where(F.col("_least") < place)
        spans = spans.unionByName(later.select("_ord", "_tkey", F.col("_pos").alias("_start"), (F.col("_pos") + length).alias("_end")))
    lost = spans.groupBy("_ord", "_tkey").agg(F.collect_list(F.struct("_start", "_end")).alias("_cuts"))
    found = cuts.put("spans", lost.unionByName(copied.withColumn("_whole", F.lit(True)), allowMissingColumns=True))
    cuts.drop(*(t for t in ("copied", "slices", "marked", "firsts", "windows", "first") if t in cuts.paths))
    kind = documents.schema[id_col].dataType.simpleString()
    return (
        keyed(documents, id_col, text_col, F.col(id_col).alias("_id"))
        .join(found, ["_ord", "_tkey"], "left")
        .select("_id", "_text", "_cuts", "_whole")
        .mapInArrow(_removal(length), f"_id {kind}, n_bytes long, n_removed long, removed array<struct<start:long,length:long>>, kept binary")
        .withColumnRenamed("_id", id_col)
    )
