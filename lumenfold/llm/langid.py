"""Language identification by compression with per-language dictionaries.

For every language of the labelled documents a zstandard raw-content dictionary is
cut from a bounded, deterministic sample: at most ``sample_docs`` documents, chosen
by hash, and ``dictionary_bytes`` of their text, taken evenly.  A text is encoded
with each dictionary; the language whose dictionary leaves the fewest bytes wins.
Case is folded first, as it says nothing about the language.  The margins to the
others, weighed against the size of the text, become the score, and a narrow
margin is a rejection.

Prediction is one map over the documents, whole texts, with the dictionaries (at
most languages * ``dictionary_bytes``) broadcast.

Defined cases: null, and text without any letter, is ``und`` with score 0; equal
sizes go to the language that sorts first and score as narrow; with no labelled
document everything is ``und``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import small_batches
from .worker import frugal

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def learn_dictionaries(
    labelled: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    sample_docs: int = 400,
    dictionary_bytes: int = 128 << 10,
    total_bytes: int = 64 << 20,
) -> dict[str, bytes]:
    """Raw-content dictionaries by language, of ``dictionary_bytes`` or, for very many languages, an equal share of ``total_bytes``."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text")).where("_lang IS NOT NULL AND length(_text) > 0")
    # copies and empty texts are no documents to choose from
    counts = rows.groupBy("_lang").agg(F.approx_count_distinct("_text").alias("_texts"))
    languages = counts.count()
    dictionary_bytes = max(1, min(dictionary_bytes, total_bytes // max(1, languages)))
    sample_docs = min(sample_docs, dictionary_bytes)
    share = max(1, dictionary_bytes // sample_docs)
    # a document gives a stretch from its middle, so that one long text cannot fill the dictionary
    stretch = F.substring("_text", 1 + F.greatest(F.lit(0), (F.length("_text") - 4 * share) / 2).cast("int"), F.lit(4 * share))
    # by hash, about four times as many documents as wanted are looked at; copies of a text count once
    hashed = rows.withColumn("_h", F.xxhash64("_text")).join(counts, "_lang")
    near = hashed.where(F.pmod("_h", F.lit(1 << 30)).cast("double") * F.col("_texts") < 4.0 * sample_docs * (1 << 30))
    texts = near.groupBy("_lang", "_h").agg(F.min(stretch).alias("_part"))
    chosen = Window.partitionBy("_lang").orderBy("_h")
    sample = texts.withColumn("_rank", F.row_number().over(chosen)).where(F.col("_rank") <= sample_docs)
    parts: dict[str, list[bytes]] = {}
    for lang, part in sample.orderBy("_lang", "_rank").select("_lang", "_part").collect():
        parts.setdefault(lang, []).append(part.lower().encode())
    out = {}
    for lang, found in parts.items():
        budget, text = dictionary_bytes, b"\n"
        for k, part in enumerate(found):  # what short documents leave goes to later ones
            take = max(share, budget // max(1, len(found) - k))
            text += part[:take] + b"\n"
            budget -= min(len(part), take) + 1
        out[lang] = text[-dictionary_bytes:]
    return out


class Classifier:
    """Sizes of a text under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 5) -> None:
        import zstandard

        self.coders = []
        for lang in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level)
            self.coders.append((lang, zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)))

    def sizes(self, text: bytes) -> list[tuple[int, str]]:
        return sorted((len(c.compress(text)), lang) for lang, c in self.coders)

    def classify(self, text: str | None) -> tuple[str, float, int]:
        """(language, score, margin in bytes)."""
        if not self.coders or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0
        found = self.sizes(text.lower().encode())
        if len(found) == 1:
            return found[0][1], 1.0, found[0][0]
        best = found[0][0]
        # each byte saved is evidence; the root keeps long texts from counting every byte as independent
        weight = 4.0 / math.sqrt(best + 16.0)
        score = 1.0 / sum(math.exp(-weight * (size - best)) for size, _ in found)
        return found[0][1], score, found[1][0] - best


def _classify(shared: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Classifier(shared.value)
        for batch in batches:
            found = [coder.classify(t.as_py()) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in batch.schema.names if c != "_text"),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.int64()),
                ],
                [*(c for c in batch.schema.names if c != "_text"), "best", "score", "margin"],
            )

    return frugal(run)


def identify_language(
    documents: DataFrame, dictionaries: dict[str, bytes], least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``documents``: id, best, score, margin (bytes) and lang, which is ``und`` where the margin is narrow."""
    kind = documents.schema[id_col].dataType.simpleString()
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)
    docs = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = docs.mapInArrow(_classify(shared), f"_id {kind}, best string, score double, margin long")
    return found.withColumn("lang", F.when(F.col("score") >= least_score, F.col("best")).otherwise(UNKNOWN)).withColumnRenamed("_id", id_col)


def held_out(id_col: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))
