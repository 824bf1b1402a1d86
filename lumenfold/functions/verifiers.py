"""Rule-based answer verification: verifiers by data source, gates, and batch rewards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import answers as A

Judge = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Verifier:
    """How an extracted answer is scored against the truth; ``least`` where either is missing."""

    name: str
    judge: Judge
    least: float = 0.0

    def score(self, answer: Column, truth: Column) -> Column:
        return F.when(answer.isNull() | truth.isNull(), F.lit(self.least)).otherwise(self.judge(answer, truth).cast("double"))


def bounded_edit_similarity(low: float, high: float) -> Judge:
    """Edit similarity stretched from [low, high] to [0, 1]."""
    return lambda a, b: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (A.edit_similarity(a, b) - low) / (high - low)))


def same_text(a: Column, b: Column) -> Column:
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    return plain(a) == plain(b)


def same_count(a: Column, b: Column) -> Column:
    number = lambda c: F.regexp_extract(c, r"-?\d+", 0).try_cast("long")
    return F.coalesce(number(a) == number(b), same_text(a, b))


#: The verifiers that need no model; a model-backed one is registered by its caller.
BUILT_IN = {
    v.name: v
    for v in (
        Verifier("math", lambda a, b: A.number_equal(a, b) | same_text(a, b)),
        Verifier("chart", A.year_exact),
        Verifier("ocr", bounded_edit_similarity(0.0, 1.0)),
        Verifier("geography", A.list_equal),
        Verifier("counting", same_count),
        Verifier("text", same_text),
    )
}


class Registry:
    """Which verifier judges which data source.  ``dispatch`` is one CASE expression."""

    def __init__(self, sources: dict[str, str], more: dict[str, Verifier] | None = None) -> None:
        self.known = BUILT_IN | (more or {})
        unknown = sorted(set(sources.values()) - set(self.known))
        if unknown:
            raise ValueError(f"no verifier named {', '.join(unknown)}")
        self.sources = sources

    def dispatch(self, source: Column, answer: Column, truth: Column) -> Column:
        found = F.lit(None).cast("double")
        for name in sorted(set(self.sources.values())):
            own = [s for s, v in self.sources.items() if v == name]
            found = F.when(source.isin(*own), self.known[name].score(answer, truth)).otherwise(found)
        return found


def reward_batch(rows: DataFrame, registry: Registry) -> DataFrame:
    """``rows`` (datasource, answer, gt_answer) with extracted, reward and the gate that refused, if one did.

    Gates in order: the answer's form, mixed languages, a missing truth, nothing
    extracted.  A refused row takes the batch's least reward, or 0 if none was given.
    """
    body = F.regexp_extract("answer", r"(?is)<answer>(.*?)</answer>", 1)
    gate = (
        F.when(~A.well_formed_answer("answer") | F.col("answer").isNull(), "format")
        .when(A.mixed_languages("answer"), "mix")
        .when(F.col("gt_answer").isNull(), "truth")
        .when(F.col("extracted").isNull(), "extract")
    )
    found = rows.withColumn("extracted", F.coalesce(A.boxed(body), F.when(F.trim(body) != "", F.trim(body)))).withColumn("gate", gate)
    judged = registry.dispatch(F.col("datasource"), F.col("extracted"), F.col("gt_answer"))
    found = found.withColumn("_raw", F.when(F.col("gate").isNull(), judged))
    least = found.agg(F.coalesce(F.min("_raw"), F.lit(0.0)).alias("_least"))
    return found.crossJoin(F.broadcast(least)).withColumn("reward", F.coalesce("_raw", "_least")).drop("_raw", "_least")  # one row


def route(rewards: DataFrame, path: str, passed: float = 1.0) -> None:
    """Rewards as JSON lines under their data source and whether they passed."""
    status = F.when(F.col("reward") >= passed, "correct").otherwise("wrong")
    rewards.withColumn("status", status).write.mode("append").partitionBy("datasource", "status").json(path)
