"""Response parsing, answer checks and text similarity as column expressions; grammar that regexes cannot express as Arrow UDFs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_token(text: str | Column) -> Column:
    """Trimmed, lower-cased, without spaces, underscores and dashes."""
    return F.lower(F.regexp_replace(F.trim(text), r"[\s_\-]+", ""))


def fenced(text: str | Column) -> Column:
    """What stands inside a Markdown code fence, or the text itself."""
    inner = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)```", 1)
    body = F.when(inner != "", inner).otherwise(F.col(text) if isinstance(text, str) else text)
    return F.regexp_replace(body, r"^\s+|\s+$", "")


def json_objects(text: str | Column) -> Column:
    """All innermost JSON objects in the text, also of a truncated list."""
    return F.regexp_extract_all(text, F.lit(r"(\{[^{}]*\})"), 1)


def score_01(value: Column) -> Column:
    """A score as a number in [0, 1]; what is no number is null."""
    number = value.try_cast("double")
    return F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def well_formed_answer(text: str | Column) -> Column:
    """A think block, then an answer block, once each, not nested, and at most one box."""
    shape = F.coalesce(F.regexp_like(text, F.lit(r"(?is)^\s*<think>.*?</think>\s*<answer>.*?</answer>\s*$")), F.lit(False))
    once = [F.regexp_count(text, F.lit(f"(?i){t}")) == 1 for t in ("<think>", "</think>", "<answer>", "</answer>")]
    return shape & once[0] & once[1] & once[2] & once[3] & (F.regexp_count(text, F.lit(r"<\|begin_of_box\|>")) <= 1)


def mixed_languages(text: str | Column, least_chinese: int = 50, least_english: int = 200) -> Column:
    """Whether one paragraph is mainly Chinese and another mainly English, both long."""
    paragraphs = F.split(text, r"\n{2,}")
    han = lambda p: F.regexp_count(p, F.lit(r"[\x{4e00}-\x{9fff}]"))
    words = lambda p: F.regexp_count(p, F.lit(r"\b[a-zA-Z]+\b"))
    total = lambda p: F.greatest(han(p) + words(p), F.lit(1))
    chinese = F.exists(paragraphs, lambda p: (han(p) >= least_chinese) & (han(p) > 0.8 * total(p)))
    english = F.exists(paragraphs, lambda p: (words(p) >= least_english) & (words(p) > 0.7 * total(p)))
    return chinese & english


def edit_similarity(a: str | Column, b: str | Column) -> Column:
    """1 - edits / longer length; two empty texts have none, which scores 0."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


def bigrams(text: Column) -> Column:
    return F.when(F.length(text) >= 2, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, 2)))).otherwise(F.array().cast("array<string>"))


def bigram_jaccard(a: Column, b: Column) -> Column:
    x, y = bigrams(a), bigrams(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def coordinate_similarity(x1: Column, y1: Column, x2: Column, y2: Column, tolerance: float = 20.0, far: float = 50.0) -> Column:
    """1 down to 0.8 within the tolerance, then falling to 0 at ``far``."""
    gap = F.sqrt((x1 - x2) ** 2 + (y1 - y2) ** 2)
    return F.when(gap <= tolerance, 1 - 0.2 * gap / tolerance).otherwise(F.greatest(F.lit(0.0), 1 - gap / far))


def number_equal(a: Column, b: Column, relative: float = 1e-4) -> Column:
    x, y = (F.regexp_replace(F.trim(c), r"[,%$°\s]", "").try_cast("double") for c in (a, b))
    return F.coalesce(F.abs(x - y) <= relative * F.greatest(F.abs(y), F.lit(1e-12)), F.lit(False))


def year_exact(a: Column, b: Column) -> Column:
    """Whether the truth is a year (1000 to 3000), which only an equal number matches."""
    year = b.rlike(r"^\s*(1\d{3}|2\d{3}|3000)\s*$")
    return F.when(year, F.trim(a) == F.trim(b)).otherwise(number_equal(a, b, 0.05))


def list_equal(a: Column, b: Column) -> Column:
    """Whether two delimited lists hold the same items in any order."""
    items = lambda c: F.array_sort(F.filter(F.transform(F.split(c, r"[,;、，；]|\band\b"), lambda s: F.lower(F.trim(s))), lambda s: s != ""))
    return F.coalesce(items(a) == items(b), F.lit(False))


def looks_like_html(text: str | Column) -> Column:
    """A document prefix or at least three tag openings."""
    prefix = F.regexp_like(text, F.lit(r"(?is)^\s*(<!doctype\s+html|<html|<\?xml)"))
    return F.coalesce(prefix | (F.regexp_count(text, F.lit(r"(?i)<(div|p|span|a|table|body|head|script|ul|li|h[1-6])\b")) >= 3), F.lit(False))


def rle_area(counts: Column) -> Column:
    """Pixels that a run-length list (gap, run, gap, run, ...) covers."""
    return F.aggregate(F.filter(counts, lambda _, i: i % 2 == 1), F.lit(0).cast("long"), lambda n, c: n + c)


def rle_pixels(counts: Column) -> Column:
    """Positions of a run-length list, in order."""
    ends = F.transform(counts, lambda _, i: F.aggregate(F.slice(counts, 1, i + 1), F.lit(0).cast("long"), lambda n, c: n + c))
    runs = F.filter(F.arrays_zip(ends.alias("e"), counts.alias("c"), F.sequence(F.lit(0), F.size(counts) - 1).alias("i")), lambda x: (x["i"] % 2 == 1) & (x["c"] > 0))
    return F.flatten(F.transform(runs, lambda x: F.sequence(x["e"] - x["c"], x["e"] - 1)))


def polygon_area(xs: Column, ys: Column) -> Column:
    """Shoelace formula over parallel coordinate arrays."""
    n = F.size(xs)
    cross = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(xs, i) * F.get(ys, (i + 1) % n) - F.get(xs, (i + 1) % n) * F.get(ys, i))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, c: a + c)) / 2


@F.pandas_udf(T.StringType())
def boxed(texts: pd.Series) -> pd.Series:
    r"""Content of the last ``\boxed{...}`` with balanced braces, else of the outermost box tokens."""

    def find(text: str | None) -> str | None:
        if text is None:
            return None
        at = text.rfind("\\boxed{")
        if at >= 0:
            depth = 0
            for k in range(at + 6, len(text)):
                depth += (text[k] == "{") - (text[k] == "}")
                if depth == 0:
                    return text[at + 7 : k]
        a, b = text.find("<|begin_of_box|>"), text.rfind("<|end_of_box|>")
        return text[a + 16 : b] if 0 <= a < b else None

    return texts.map(find)


@F.pandas_udf(T.DoubleType())
def lcs_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Longest common subsequence over the longer length; two empty texts are alike."""

    def ratio(a: str | None, b: str | None) -> float | None:
        if a is None or b is None:
            return None
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b, 1):
                last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
        return row[-1] / max(len(a), len(b)) if a or b else 1.0

    return pd.Series([ratio(a, b) for a, b in zip(left, right, strict=True)])
