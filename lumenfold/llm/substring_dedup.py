"""Exact substring de-duplication over words by level-wise doubling.

A *window* is ``window`` consecutive words of one document.  A document loses
every word covered by a window whose word sequence also starts in a document with
a smaller id; windows are judged on the input, so the order of removal is moot.

Levels double from a quarter of the window (13, 25 and 50 words by default).  At a
level of ``k`` words each still-living window is represented by the smallest hash
among the ``k``-word windows inside it.  Equal windows have equal representatives,
so a window whose representative is found in one document only cannot repeat and
dies; only windows repeated at one length are extended to twice that length.  The
representatives of neighbouring windows mostly coincide, so the first level moves
one row for about twenty words instead of one for each.  At the full length every
survivor is keyed by a 128-bit hash and compared with the smallest document id
that holds it.  The ladder ends early when no candidate survives.  Whole-text copies
lose all their windows to the smallest id of their group, so they are set aside
before the levels.

Scale: a level is a partial aggregation by hash (a hot hash combines before the
shuffle) and an equi-join that AQE may split; no group is ever collected, apart
from the positions of one document.  Phases are cut by tables in the shared
checkpoint folder.

Defined cases: a null text has no words; a null id counts as larger than all
others; rows repeated with one id never remove each other's words; documents of
fewer words than the window keep all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .rolling import WORD_BASES, sliding, text_runs, window_hash, words_of
from .store import Cuts
from .worker import frugal

LAST = (1 << 63) - 1


def ladder(window: int, least: int = 8) -> list[int]:
    """Lengths below ``window`` that double up to it: 13, 25 for 50."""
    out: list[int] = []
    k = window
    while (k := -(-k // 2)) >= least and len(out) < 2:
        out.append(k)
    return out[::-1]


def keyed(documents: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(_ord, _tkey, _text, *more): rank by id with null last, and a key that tells apart texts that share an id."""
    kind = documents.schema[id_col].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{id_col} is {kind.simpleString()}; ids must be whole numbers")
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    return documents.select(order.alias("_ord"), F.xxhash64(text).alias("_tkey"), text.alias("_text"), *more)


def of_documents(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column without nulls in it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False), offsets


def valid_windows(first: np.ndarray, window: int) -> np.ndarray:
    """For every word of a run: whether a whole window of its text starts there."""
    n = int(first[-1])
    end = np.repeat(first[1:], np.diff(first))
    return np.arange(n) + window <= end


def owner(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _representatives(k: int, window: int, previous: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct representatives of ``k`` words in each document, of windows alive after ``previous``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, tkeys = of_documents(batch.column("_ord")), of_documents(batch.column("_tkey"))
            alive = listed(batch.column("_alive")) if previous else None
            for i, j, data, offsets in text_runs(batch.column("_text")):
                _, _, first, units = words_of(data, offsets)
                at = np.flatnonzero(valid_windows(first, window))
                if not len(at):
                    continue
                best = sliding(window_hash(units, k, WORD_BASES[0]), window - k + 1, np.minimum)
                doc = owner(first)[at]
                if alive:
                    keep = living(units, at, doc, alive, i, j, previous, window)
                    at, doc = at[keep], doc[keep]
                values = best[at]
                change = np.ones(len(values), dtype=bool)
                change[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
                values, doc = values[change], doc[change]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(ords[i:j][doc]), pa.array(tkeys[i:j][doc])], ["_key", "_ord", "_tkey"]
                )

    return frugal(run)


def living(units: np.ndarray, at: np.ndarray, doc: np.ndarray, alive: tuple[np.ndarray, np.ndarray], i: int, j: int, k: int, window: int) -> np.ndarray:
    """Which windows have a representative of ``k`` words among their own document's survivors."""
    values, offsets = alive
    best = sliding(window_hash(units, k, WORD_BASES[0]), window - k + 1, np.minimum)[at].view(np.int64)
    keep = np.zeros(len(at), dtype=bool)
    bounds = np.searchsorted(doc, np.arange(j - i + 1))
    for d in range(j - i):
        a, b = bounds[d], bounds[d + 1]
        if a < b:
            keep[a:b] = np.isin(best[a:b], values[offsets[i + d] : offsets[i + d + 1]])
    return keep


def _windows(window: int, previous: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Surviving windows of full length with 128-bit keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, tkeys = of_documents(batch.column("_ord")), of_documents(batch.column("_tkey"))
            alive = listed(batch.column("_alive"))
            for i, j, data, offsets in text_runs(batch.column("_text")):
                _, _, first, units = words_of(data, offsets)
                at = np.flatnonzero(valid_windows(first, window))
                if not len(at):
                    continue
                doc = owner(first)[at]
                keep = living(units, at, doc, alive, i, j, previous, window)
                at, doc = at[keep], doc[keep]
                h1, h2 = (window_hash(units, window, b)[at].view(np.int64) for b in WORD_BASES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(ords[i:j][doc]), pa.array(tkeys[i:j][doc]), pa.array((at - first[doc]).astype(np.int32))],
                    ["_h1", "_h2", "_ord", "_tkey", "_pos"],
                )

    return frugal(run)


def exact_copies(docs: DataFrame) -> DataFrame:
    """(_ord, _tkey) of documents whose whole text also has a smaller id."""
    texts = docs.select("_ord", "_tkey", F.xxhash64(F.lit(1), "_text").alias("_second"))
    groups = texts.groupBy("_tkey", "_second").agg(F.min("_ord").alias("_lo"), F.max("_ord").alias("_hi")).where("_lo < _hi").drop("_hi")
    return texts.join(groups, ["_tkey", "_second"]).where("_ord > _lo").select("_ord", "_tkey").distinct()


def survivors(cuts: Cuts, tag: str, rows: DataFrame, copies: DataFrame) -> DataFrame:
    """(_ord, _tkey, _alive): the keys that other texts have too, of each document but copies.

    The shared keys are a table of their own, so that the join reads two plain
    exchanges, of which Spark can split a hot key's.
    """
    bounds = rows.groupBy("_key").agg(F.min("_tkey").alias("_lo"), F.max("_tkey").alias("_hi")).where("_lo < _hi")
    lists = rows.join(cuts.put(tag, bounds.select("_key")), "_key").groupBy("_ord", "_tkey").agg(F.collect_set("_key").alias("_alive"))
    return lists.join(copies, ["_ord", "_tkey"], "left_anti")


def _removal(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "n_removed": [], "removed": [], "text": []}
            for text, starts, copy in zip(batch.column("_text"), batch.column("_starts"), batch.column("_copy"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                if copy.is_valid and len(words) >= window:
                    cover[[0, -1]] = 1, -1
                elif starts.is_valid:
                    s = starts.values.to_numpy(zero_copy_only=False)
                    np.add.at(cover, s, 1)
                    np.add.at(cover, s + window, -1)
                gone = np.cumsum(cover[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["removed"].append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                out["text"].append(b" ".join([words[x] for x in np.flatnonzero(~gone)] if len(edge) else words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["removed"], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array(out["text"], pa.string()),
                ],
                ["_id", "n_words", "n_removed", "removed", "text"],
            )

    return frugal(run)


def substring_dedup(documents: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: id, n_words, n_removed, removed (word spans) and the kept text.

    Kept words are joined by single spaces.
    """
    cuts = Cuts(documents.sparkSession, "substring")
    docs = keyed(documents, id_col, text_col)
    levels = ladder(window) or [window]
    copies = cuts.put("copies", exact_copies(docs))
    alive, previous = None, None
    for k in levels:
        source = docs if alive is None else docs.join(alive, ["_ord", "_tkey"])
        rows = cuts.put(f"level{k}", source.mapInArrow(_representatives(k, window, previous), "_key long, _ord long, _tkey long"))
        alive, last = cuts.put(f"alive{k}", survivors(cuts, f"shared{k}", rows, copies)), previous
        cuts.drop(f"level{k}", f"shared{k}", *([f"alive{last}"] if last else []))
        previous = k
        if alive.isEmpty():
            break
    found = cuts.put(
        "windows",
        docs.join(alive, ["_ord", "_tkey"]).mapInArrow(_windows(window, previous), "_h1 long, _h2 long, _ord long, _tkey long, _pos int"),
    )
    cuts.drop(f"alive{previous}")
    earliest = found.groupBy("_h1", "_h2").agg(F.min("_ord").alias("_lo"), F.max("_ord").alias("_hi")).where("_lo < _hi").drop("_hi")
    later = found.join(cuts.put("earliest", earliest), ["_h1", "_h2"]).where("_ord > _lo")
    starts = later.groupBy("_ord", "_tkey").agg(F.collect_set("_pos").alias("_starts"))
    gone = cuts.put("gone", starts.unionByName(copies.withColumn("_copy", F.lit(True)), allowMissingColumns=True))
    cuts.drop("windows", "earliest", "copies")
    kind = documents.schema[id_col].dataType.simpleString()
    texts = keyed(documents, id_col, text_col, F.col(id_col).alias("_id"))
    return (
        texts.join(gone, ["_ord", "_tkey"], "left")
        .select("_id", "_text", "_starts", "_copy")
        .mapInArrow(_removal(window), f"_id {kind}, n_words long, n_removed long, removed array<struct<start:long,length:long>>, text string")
        .withColumnRenamed("_id", id_col)
    )
