"""Best-fit packing of tokenised documents by exact-complement hashing.

Documents become token ids with a closing id, and only those longer than a
sequence are cut.  How to fill sequences depends on the lengths alone, so the plan
is made from the histogram of lengths: at most ``capacity`` counts, whatever the
size of the corpus.

The planner starts a pattern with the longest length left and asks an index of
single, pair and triple length sums for a combination that fills the gap exactly
under the counts still available; where there is none, the best-fitting single
length goes in and the search repeats for the smaller gap.  A pattern is used as
often as its counts allow, so every step nearly exhausts a length: the plan has at
most about ``capacity * (1 + ln capacity)`` patterns.

Pieces then find their places without any global order: within a length, a piece's
rank is its block's prefix count plus its rank in the block, and ranks map to
sequences and offsets by the plan's ranges.  A length that a third of all pieces
have is spread over as many blocks as it needs.

Defined cases: null and empty texts are the closing id alone; repeated rows are
packed as often as they occur.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rolling import text_runs
from .store import Cuts
from .substring_dedup import keyed
from .worker import FORGET, frugal

#: Words whose ids a worker keeps; then it starts anew.
MEMO_WORDS = 400_000
#: An ASCII letter and an ASCII sign or digit after it; an apostrophe may open a contraction.
_AFTER_LETTER = re.compile(rb"([a-z])([!-&(-@\[-`{-~])")


class WordEncoder:
    """Ids of whole texts, remembering those of each space-separated word.

    For tokenizers that fold case and never join across white space or between a
    letter and a sign, which ``splits_at_spaces`` says; the ids equal those of encoding
    the text as a whole.  Texts that may hold a special token are encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_spaces(self.tokenizer)
        self.marker = b"<|"
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.lengths = np.zeros(1024, dtype=np.int32)
        self.starts = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(1 << 14, dtype=np.uint32)
        self.used = 0

    def learn(self, words: list[bytes]) -> None:
        """Encode new words, joined by spaces, and tell their ids apart by where they start."""
        texts = [w.decode() for w in words]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.uint32)
        at = np.fromiter(map(itemgetter(0), found.offsets), dtype=np.int64, count=len(ids))
        sizes = np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=len(words)).astype(np.int32)
        n = len(self.memo)
        while n + len(words) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.lengths[n : n + len(words)] = sizes
        self.starts[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.memo.update(zip(words, range(n, n + len(words)), strict=True))

    def plain(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype=np.uint32) for x in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_word:
            return self.plain(texts)
        special = [x for x, t in enumerate(texts) if self.marker in t]
        if special:
            out = iter(self.encode([t for t in texts if self.marker not in t]))
            whole = dict(zip(special, self.plain([texts[x] for x in special]), strict=True))
            return [whole[x] if x in whole else next(out) for x in range(len(texts))]
        # lower case and a space between a letter and what follows it spare the memo variants
        words = [_AFTER_LETTER.sub(rb"\1 \2", t.lower()).split() for t in texts]
        flat = list(chain.from_iterable(words))
        index = np.fromiter(map(self.memo.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        missing = np.flatnonzero(index < 0)
        if len(missing):
            unknown = [flat[x] for x in missing]
            new = list(dict.fromkeys(unknown))
            if len(self.memo) + len(new) > MEMO_WORDS:
                self.forget()
                missing, unknown, new = np.arange(len(flat)), flat, list(dict.fromkeys(flat))
            self.learn(new)
            index[missing] = np.fromiter(map(self.memo.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        sizes = self.lengths[index].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[index] - (ends - sizes), sizes) + np.arange(total)]
        cuts = np.concatenate([[0], ends])[np.cumsum([len(ws) for ws in words])]
        return np.split(ids, cuts[:-1])


def splits_at_spaces(tokenizer: object) -> bool:
    """Whether case is folded and only runs of letters, single digits and runs of signs are kept, as contractions or alone.

    Anything else is encoded text by text.
    """
    spec = json.loads(tokenizer.to_str())
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    folds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    kept = [a for a in (steps[0].get("pattern") or {}).get("Regex", "").split("|") if not a.startswith("'")]
    removes = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
    marks = all(t["content"].startswith("<|") for t in spec.get("added_tokens", []))
    return removes and marks and "Lowercase" in folds and kept == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


FORGET["packing"] = encoder.cache_clear


def _pieces(path: str, capacity: int, closing: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            for i, j, data, offsets in text_runs(batch.column("_text")):
                raw = data.tobytes()
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for d, own in enumerate(code.encode([raw[offsets[k] : offsets[k + 1]] for k in range(j - i)])):
                    own = np.append(own, np.uint32(closing)).astype("<u4")
                    for p, a in enumerate(range(0, len(own), capacity)):
                        part = own[a : a + capacity]
                        rows.append(i + d)
                        piece.append(p)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            ids.append(part.astype(np.int32))
                part = batch.select(["_id", "_ord", "_tkey"]).take(pa.array(rows, pa.int64()))
                columns = list(part.columns)
                columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["_id", "_ord", "_tkey", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return frugal(run, "packing")


class ComplementIndex:
    """Which gaps single lengths, pairs and triples of available lengths fill exactly."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.copy()
        self.here = self.left > 0
        self.pairs: np.ndarray | None = None

    def use(self, length: int, times: int) -> None:
        self.left[length] -= times
        if self.left[length] == 0:
            self.here[length] = False
            self.pairs = None

    def longest(self, most: int) -> int:
        at = np.flatnonzero(self.here[: most + 1])
        return int(at[-1]) if len(at) else 0

    def pair_sums(self) -> np.ndarray:
        if self.pairs is None:
            n = 2 * len(self.here)
            f = np.fft.rfft(self.here.astype(np.float64), n)
            self.pairs = np.fft.irfft(f * f, n)[: len(self.here)] > 0.5
        return self.pairs

    def fits(self, chosen: list[int]) -> bool:
        return all(self.left[x] >= chosen.count(x) for x in set(chosen))

    def single(self, gap: int, inside: list[int]) -> list[int] | None:
        return [gap] if self.here[gap] and self.fits([*inside, gap]) else None

    def pair(self, gap: int, inside: list[int]) -> list[int] | None:
        low = self.here[1 : gap // 2 + 1]  # the shorter of the two: 1 .. gap // 2
        high = self.here[gap - 1 : gap - 1 - len(low) : -1] if len(low) else low
        for k in np.flatnonzero(low & high):
            found = [gap - 1 - int(k), 1 + int(k)]
            if self.fits([*inside, *found]):
                return found
        return None

    def triple(self, gap: int, inside: list[int]) -> list[int] | None:
        if gap < 3:
            return None
        sums = self.pair_sums()
        for k in np.flatnonzero(self.here[1 : gap - 1] & sums[gap - 1 : 1 : -1])[::-1]:
            a = 1 + int(k)
            if self.fits([*inside, a]) and (rest := self.pair(gap - a, [*inside, a])):
                return [a, *rest]
        return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths) of patterns that use up ``counts`` (by length, 0 unused)."""
    index = ComplementIndex(counts)
    out: list[tuple[int, list[int]]] = []
    while longest := index.longest(capacity):
        chosen, gap = [longest], capacity - longest
        while gap:
            found = index.single(gap, chosen) or index.pair(gap, chosen) or index.triple(gap, chosen)
            if found:
                chosen += found
                break
            fit = next((int(x) for x in np.flatnonzero(index.here[: gap + 1])[::-1] if index.fits([*chosen, int(x)])), 0)
            if not fit:
                break
            chosen.append(fit)
            gap -= fit
        times = min(int(index.left[x]) // chosen.count(x) for x in set(chosen))
        for x in set(chosen):
            index.use(x, times * chosen.count(x))
        out.append((times, chosen))
    return out


Ranges = dict[int, tuple[np.ndarray, ...]]


def ranges_of(patterns: list[tuple[int, list[int]]]) -> Ranges:
    """For each length, ranges of ranks: first rank, first sequence, copies in a sequence, first offset."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for times, chosen in patterns:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            copies = chosen.count(length)
            rank = seen.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, copies, offset))
            seen[length] = rank + times * copies
            offset += length * copies
        sequence += times
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in rows.items()}


def _placed(ranges: Ranges) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                first, base, copies, at = ranges[int(k)]
                r = np.searchsorted(first, rank[own], side="right") - 1
                inside = rank[own] - first[r]
                sequence[own] = base[r] + inside // copies[r]
                offset[own] = at[r] + inside % copies[r] * k
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return frugal(run)


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    closing: int = 0,
    with_ids: bool = False,
    block_rows: int = 50_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    cuts = Cuts(documents.sparkSession, "packing")
    kind = documents.schema[id_col].dataType.simpleString()
    tail = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = keyed(documents, id_col, text_col, F.col(id_col).alias("_id"))
    pieces = cuts.put("pieces", docs.mapInArrow(_pieces(tokenizer_path, capacity, closing, with_ids), f"_id {kind}, _ord long, _tkey long, {tail}"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    ranges = ranges_of(plan(counts, capacity))
    blocks = max(1, math.ceil(int(counts.sum()) / block_rows))
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64("_ord", "_tkey", "piece"), F.lit(blocks)))
    by_block = dealt.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_block.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_block").orderBy("_ord", "_tkey", "piece")
    ranked = dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(bases, ["length", "_block"])
    names = ["_id", *(c for c in pieces.columns if c not in ("_id", "_ord", "_tkey"))]
    shared = documents.sparkSession.sparkContext.broadcast(ranges)
    return (
        ranked.select(*names, (F.col("_base") + F.col("_inside")).alias("_rank"))
        .mapInArrow(lambda it: _placed(shared.value)(it), f"_id {kind}, {tail}, sequence_id long, offset long")
        .withColumnRenamed("_id", id_col)
    )
