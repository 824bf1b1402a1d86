"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Text is lower-cased (A-Z only) and cut into words of digits, letters and anything
beyond ASCII.  A benchmark window is ``n`` consecutive words of an item; an item of
fewer words is one window.  Every place where a window occurs in a document is
found by a rolling hash, verified word by word, and either its span or its document
is removed.

The window set is broadcast in blocks of items of at most ``block_bytes`` of text
each, an index of some tens of bytes a word and window, so what any executor holds is
bounded however large the benchmark grows; a further block costs a further scan of the
documents, one index is broadcast at a time, and the scans' findings are merged per
document.

Defined cases: null text or an item without words never matches; items may share
windows and ids; a null item id is reported as ``null``; a null document id is kept
as it is.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rolling import WORD_BASES, byte_hash, byte_prefix, spans, text_runs, window_hash
from .store import Cuts, small_batches
from .substring_dedup import keyed, owner
from .worker import frugal

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: length -> (sorted hashes, hash -> [(words joined by a space, item ids)])
Index = dict[int, tuple[np.ndarray, dict[int, list[tuple[bytes, tuple[str, ...]]]]]]

SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def normal_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, each text's first word, word hashes."""
    data = LOWER[data]
    starts, ends, first = spans(IN_WORD[data], offsets)
    return data, starts, ends, first, byte_hash(byte_prefix(data), starts, ends)


def build_index(items: list[tuple[str, str]], n: int) -> Index:
    texts = pa.array([t for _, t in items], pa.string())
    windows: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for i, j, raw, offsets in text_runs(texts):
        data, starts, ends, first, units = normal_words(raw, offsets)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            size = min(n, b - a)
            if size:
                for x, h in enumerate(window_hash(units[a:b], size, WORD_BASES[0])):
                    windows[size][int(h)][b" ".join(words[a + x : a + x + size])].add(items[i + d][0])
    return {
        size: (np.array(sorted(found), dtype=np.uint64), {h: [(w, tuple(sorted(ids))) for w, ids in same.items()] for h, same in found.items()})
        for size, found in windows.items()
    }


def _scan(shared: Broadcast, keep_text: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            for i, j, raw, offsets in text_runs(batch.column("_text")):
                data, starts, ends, first, units = normal_words(raw, offsets)
                cover = np.zeros(len(units) + 1, dtype=np.int64)
                doc = owner(first)
                items: list[set[str]] = [set() for _ in range(j - i)]
                for size, (hashes, known) in index.items():
                    found = window_hash(units, size, WORD_BASES[0])
                    spot = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    at = np.flatnonzero(hashes[spot] == found)
                    for x in at[doc[at] == doc[at + size - 1]]:
                        words = b" ".join([data[starts[y] : ends[y]].tobytes() for y in range(x, x + size)])
                        for text, ids in known[int(found[x])]:
                            if text == words:
                                cover[x] += 1
                                cover[x + size] -= 1
                                items[doc[x]].update(ids)
                hit = np.cumsum(cover[:-1]) > 0
                bounds = np.zeros(len(first), dtype=np.int64)
                np.cumsum(np.bincount(doc[hit], minlength=j - i), out=bounds[1:])
                listed: list[list[dict[str, int]]] = []
                for d in range(j - i):
                    own = hit[first[d] : first[d + 1]]
                    if bounds[d] == bounds[d + 1]:
                        listed.append([])
                        continue
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                    listed.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                part = batch.slice(i, j - i)
                names = [c for c in part.schema.names if keep_text or c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in names),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(listed, SPAN),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ],
                    [*names, "n_words", "hits", "items"],
                )

    return frugal(run)


def merged(spans_of: list[dict[str, int]]) -> list[dict[str, int]]:
    """Spans that overlap or touch become one."""
    out: list[dict[str, int]] = []
    for s in sorted(spans_of, key=lambda x: x["start"]):
        if out and s["start"] <= out[-1]["start"] + out[-1]["length"]:
            out[-1]["length"] = max(out[-1]["length"], s["start"] + s["length"] - out[-1]["start"])
        else:
            out.append(dict(s))
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.names.index("hits")
        yield batch.set_column(at, "hits", pa.array([merged(x) for x in batch.column(at).to_pylist()], SPAN))


def index_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """How many blocks of about ``block_bytes`` the benchmark makes, and each one's items; an item never splits."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("_item"), F.col(text_col).alias("_words"))
    items = items.where("_words IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("_words"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("_item", "_words"), F.lit(n)) == b) if n > 1 else items
        yield n, [(r[0], r[1]) for r in block.collect()]


SCANNED = "n_words long, hits array<struct<start:long,length:long>>, items array<string>"


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    block_bytes: int = 4 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: id, n_words, hits (word spans) and items (sorted ids)."""
    spark = documents.sparkSession
    small_batches(spark)
    kind = documents.schema[id_col].dataType.simpleString()
    docs = keyed(documents, id_col, text_col, F.col(id_col).alias("_id"))
    blocks = index_blocks(benchmark, item_col, item_text_col, block_bytes)
    count, first = next(blocks)
    if count == 1:
        shared = spark.sparkContext.broadcast(build_index(first, n))
        return docs.select("_id", "_text").mapInArrow(_scan(shared), f"_id {kind}, {SCANNED}").withColumnRenamed("_id", id_col)
    cuts = Cuts(spark, "leaks")
    head, scans = "_ord long, _tkey long", []
    for k, block in enumerate(chain([first], (block for _, block in blocks))):  # one index is held at a time
        shared = spark.sparkContext.broadcast(build_index(block, n))
        scans.append(cuts.put(f"block{k}", docs.select("_ord", "_tkey", "_text").distinct().mapInArrow(_scan(shared), f"{head}, {SCANNED}")))
        shared.destroy()
    together = reduce(DataFrame.unionByName, scans).groupBy("_ord", "_tkey")
    found = together.agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    ).mapInArrow(_merge, f"{head}, {SCANNED}")
    return docs.select("_id", "_ord", "_tkey").join(found, ["_ord", "_tkey"]).select(F.col("_id").alias(id_col), "n_words", "hits", "items")


def n_hit(hits: str | Column = "hits") -> Column:
    """How many words the spans in ``hits`` cover."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["length"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes from the first to the last word of each hit span."""
    for batch in batches:
        out = []
        for text, hits in zip(batch.column("_text"), batch.column("hits"), strict=True):
            if not hits.is_valid or not len(hits.values):
                out.append(text.as_py())
                continue
            raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
            starts, ends, _ = spans(IN_WORD[LOWER[raw]], np.array([0, len(raw)]))
            keep = np.ones(len(raw), dtype=bool)
            for s in hits.as_py():
                keep[starts[s["start"]] : ends[s["start"] + s["length"] - 1]] = False
            out.append(raw[keep].tobytes().decode())
        at = batch.schema.names.index("_text")
        yield batch.set_column(at, "_text", pa.array(out, pa.string())).drop_columns(["hits"])


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    remove: str = "documents",
    block_bytes: int = 4 << 20,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``documents`` with contaminated documents or, for remove="spans", their hit spans taken out.

    All columns pass through and no row is shuffled: each block of the benchmark is
    one map over the documents.  With "spans" a later block sees the text that an
    earlier one left.  A null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    spark = documents.sparkSession
    small_batches(spark)
    names = [f"_c{k}" for k in range(len(documents.columns))]
    types = [f.dataType.simpleString() for f in documents.schema]
    rows = documents.toDF(*names)
    at = names[documents.columns.index(text_col)]
    schema = ", ".join(f"{c} {t}" for c, t in zip(names, types, strict=True))
    for _, block in index_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(build_index(block, n))
        found = rows.withColumn("_text", F.coalesce(F.col(at), F.lit(""))).mapInArrow(_scan(shared, keep_text=True), f"{schema}, _text string, {SCANNED}")
        if remove == "documents":
            rows = found.where(F.size("hits") == 0).select(*names)
        else:
            cut = found.select(*names, "_text", "hits").mapInArrow(_without, f"{schema}, _text string")
            rows = cut.withColumn(at, F.when(F.col(at).isNotNull(), F.col("_text"))).select(*names)
    return rows.toDF(*documents.columns)
