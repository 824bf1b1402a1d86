"""Quality rules whose cut-offs adapt to each language and source.

Everything here is DataFrame functions: no Python touches a row.

Fixed rules come first: too few words, or too many words in repeated 8-word
windows, fail a document.  What remains of a source's text in a language sets that
group's own limits: each measure goes into a mergeable KLL quantile sketch by
(language, source), kept exact up to the sketch's size, and the group's limits are its
robust range, ``low`` and ``high`` quantiles widened by ``spread`` times their
distance (plus ``slack``, so that a measure that is constant in a group leaves room).
Sketches of a group's sources also merge into its language's sketch, which serves
groups of fewer than ``least_rows`` documents.  The limits are joined back and filter.

Sketches are partial aggregates: a group with a third of all rows combines on every
task before the shuffle, and what is joined back is one row per group, small enough
to broadcast while groups are few and an equi-join with skew splitting beyond.

Defined cases: a null text has no words and fails; null languages or sources form
groups of their own; ties with a limit are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Cuts

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 8
#: Added to a text's lines, so that one repeated line in a short text is a small rate.
FEW_LINES = 5
MEASURES = ("mean_word", "symbol_rate", "dup_line_rate")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _window(words: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.slice(words, i, RUN))


def with_repeated_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words: how many of _words lie in an 8-word window that occurs twice or more.

    Window hashes tell most texts apart from those with any repeat; only the latter
    compare window strings.  Each step is a column of its own, as what a lambda
    refers to would be computed for every element otherwise.
    """
    n = F.size("_words")
    places = F.when(n >= RUN, F.sequence(F.lit(1), n - (RUN - 1))).otherwise(F.array().cast("array<int>"))
    distinct = F.size(F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.slice("_words", i, RUN)))))
    rows = rows.withColumn("_again", distinct < n - (RUN - 1))
    pairs = F.array_sort(F.transform(places, lambda i: F.struct(_window(F.col("_words"), i).alias("w"), i.alias("i"))))
    rows = rows.withColumn("_pairs", F.when(F.col("_again"), pairs))
    same = lambda p, k: F.get("_pairs", k)["w"].eqNullSafe(p["w"])
    starts = F.transform("_pairs", lambda p, k: F.when(same(p, k - 1) | same(p, k + 1), p["i"]))
    rows = rows.withColumn("_starts", F.array_sort(F.filter(starts, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + RUN - F.greatest(a["end"], i)).alias("n"), (i + RUN).alias("end")),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_again", "_pairs", "_starts")


def base_measures(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` without its text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _lines and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    keep = [c for c in documents.columns if c != text_col]
    rows = documents.select(
        *keep,
        words_of(text).alias("_words"),
        lines.alias("_own_lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(F.translate(text, SPACES, ""))).cast("long").alias("word_chars"),
    )
    rows = with_repeated_words(rows).select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_own_lines") - F.size(F.array_distinct("_own_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_own_lines").alias("_lines"),
    )
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _measures() -> dict[str, Column]:
    return {
        "mean_word": F.try_divide("word_chars", "n_words"),
        "symbol_rate": F.try_divide("n_symbols", "word_chars"),
        "dup_line_rate": F.col("n_dup_lines") / (F.col("_lines") + FEW_LINES),
    }


def adaptive_limits(
    measured: DataFrame, groups: tuple[str, str], low: float, high: float, spread: float, slack: dict[str, float], least_rows: int, k: int
) -> DataFrame:
    """One row per (language, source) of ``measured``: _lo_*, _hi_* of each measure."""
    lang, source = groups
    passed = measured.where("NOT base_failed")
    sketches = passed.groupBy(lang, source).agg(
        F.count(F.lit(1)).alias("_n"), *(F.kll_sketch_agg_double(c, k).alias(f"_s_{m}") for m, c in _measures().items())
    )
    merged = sketches.groupBy(lang).agg(*(F.kll_merge_agg_double(f"_s_{m}", k).alias(f"_l_{m}") for m in MEASURES))
    at = F.array(F.lit(low), F.lit(high))

    def limits(m: str) -> list[Column]:
        sketch = F.when(F.col("_n") >= least_rows, F.col(f"_s_{m}")).otherwise(F.col(f"_l_{m}"))
        q = F.kll_sketch_get_quantile_double(sketch, at)
        margin = spread * (q[1] - q[0]) + slack[m]
        return [(q[0] - margin).alias(f"_lo_{m}"), (q[1] + margin).alias(f"_hi_{m}")]

    joined = sketches.join(merged.withColumnRenamed(lang, "_lang"), F.col(lang).eqNullSafe(F.col("_lang")))
    return joined.select(F.col(lang).alias("_group_lang"), F.col(source).alias("_group_source"), *(c for m in MEASURES for c in limits(m)))


def quality_verdicts(
    documents: DataFrame,
    low: float = 0.25,
    high: float = 0.75,
    spread: float = 3.0,
    slack: dict[str, float] | None = None,
    least_rows: int = 30,
    k: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """id, the base measures, base_failed and kept, one row per row of ``documents``."""
    slack = slack or {"mean_word": 1.0, "symbol_rate": 0.02, "dup_line_rate": 0.2}
    rows = documents.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang_of"), F.col(source_col).alias("_source_of"), F.col(text_col).alias("_text_of"))
    measured = Cuts(documents.sparkSession, "quality").put("measured", base_measures(rows, "_text_of"))
    limits = adaptive_limits(measured, ("_lang_of", "_source_of"), low, high, spread, slack, least_rows, k)
    inside = F.lit(True)
    for m, c in _measures().items():
        inside = inside & (c >= F.col(f"_lo_{m}")) & (c <= F.col(f"_hi_{m}"))
    joined = measured.join(limits, F.col("_lang_of").eqNullSafe(F.col("_group_lang")) & F.col("_source_of").eqNullSafe(F.col("_group_source")), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
