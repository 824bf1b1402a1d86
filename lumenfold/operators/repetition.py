"""How often texts repeat themselves, counted text by text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of one id's texts that are counted in one place; windows of more are counted in a distributed aggregation.
GATHERED = 1 << 24
#: Bits of a window's code.
BITS = 62


def most_frequent(texts: list[str], width: int) -> int:
    """How often the most frequent window of ``width`` characters occurs in the texts; 0 if there is none.

    Windows are told apart by codes that are equal for equal windows only: the ranks of
    their characters side by side, as many as fit, then pairs of ranks of such codes.
    """
    points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts if len(t) >= width]
    if not points:
        return 0
    every = np.concatenate(points) if len(points) > 1 else points[0]
    there = np.zeros(int(every.max()) + 1, dtype=bool)
    there[every] = True
    ranks = (np.cumsum(there) - 1)[every]
    bits = max(1, int(ranks.max()).bit_length())
    covered = min(width, BITS // bits)
    codes = ranks[: len(ranks) - covered + 1].copy()
    for k in range(1, covered):
        codes <<= bits
        codes |= ranks[k : len(ranks) - covered + 1 + k]
    while covered < width:
        step = min(covered, width - covered)
        _, ranks = np.unique(codes, return_inverse=True)
        codes = ranks[: len(ranks) - step] * len(ranks) + ranks[step:]
        covered += step
    if len(points) > 1:  # no window spans two texts
        ends = np.cumsum([len(p) for p in points])[:-1]
        spans = (ends[:, None] - np.arange(1, width)).ravel()
        codes = np.delete(codes, spans)
    codes.sort()
    new = np.flatnonzero(codes[1:] != codes[:-1]) + 1
    return int(np.diff(np.concatenate([[0], new, [len(codes)]])).max())


def _counted(ident: str, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = [most_frequent(t if isinstance(t, list) else [t], width) for t in (x.as_py() for x in batch.column("_texts"))]
            yield pa.RecordBatch.from_arrays([batch.column(ident), pa.array(most, pa.int64())], [ident, "most"])

    return run


def most_repeated(texts: DataFrame, ident: str, text: str, width: int) -> DataFrame:
    """(ident, most): how often the most frequent window of ``width`` characters occurs in all texts of an id; ids without a window have no row.

    The text of an id of its own is counted where it is read.  Texts that share an id are
    gathered, up to ``GATHERED`` characters; windows of more are rows of an aggregation.
    """
    rows = texts.select(ident, F.col(text).alias("_texts")).where(F.length("_texts") >= width)
    schema = f"`{ident}` {rows.schema[ident].dataType.simpleString()}, most long"
    shared = rows.groupBy(ident).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("_texts").cast("long")).alias("_chars")).where("_n > 1")
    if shared.isEmpty():
        return rows.mapInArrow(_counted(ident, width), schema)
    shared = shared.withColumnRenamed(ident, "_shared")
    rows = rows.join(shared, F.col(ident).eqNullSafe(F.col("_shared")), "left")
    found = rows.where("_n IS NULL").select(ident, "_texts").mapInArrow(_counted(ident, width), schema)
    some = rows.where(F.col("_chars") <= GATHERED).groupBy(ident).agg(F.collect_list("_texts").alias("_texts"))
    found = found.unionByName(some.mapInArrow(_counted(ident, width), schema))
    # stretches first: finding a character by its number takes time in proportion to it
    cut = F.expr(f"transform(sequence(0, (length(_texts) - {width}) div 200), b -> substring(_texts, 200 * b + 1, {199 + width}))")
    parts = rows.where(F.col("_chars") > GATHERED).select(ident, F.explode(cut).alias("_part"))
    grams = parts.select(ident, F.explode(F.expr(f"transform(sequence(1, length(_part) - {width - 1}), i -> substring(_part, i, {width}))")).alias("_g"))
    return found.unionByName(grams.groupBy(ident, "_g").agg(F.count(F.lit(1)).alias("_c")).groupBy(ident).agg(F.max("_c").alias("most")))
