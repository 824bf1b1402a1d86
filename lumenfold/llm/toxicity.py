"""Toxicity from a weighted finite-state grammar over clauses.

A text is cut into clauses, and a word automaton labels each word with terminals (insult,
threat, target, negation, report, quote).  Three transducers, composed into one, rewrite a
clause's labels; their arcs have weights, and the best path decides how a clause reads:

* negation: an insult or threat within ``REACH`` words after a negation becomes *negated*
  ("not an idiot");
* reported speech: an insult or threat after a reporting verb or in quotes becomes
  *reported*;
* matching: an insult alone is *insult*; with a target within ``REACH`` words, in either
  order, it is *targeted*; a threat verb followed by a target is *threat*.  An insult may
  wait for a target or stand alone, a target may wait for an insult or pass: the
  transducer leaves it open, and the path of largest weight is taken.

Negated and reported matches weigh little, so an isolated word in a denial does not
convict a text.  A text's features are how often each construction lies on the best paths
of its clauses, up to ``CAP`` times; their weights come from labelled rows by logistic
regression (Newton steps over sufficient statistics of at most 4**5 distinct feature rows,
aggregated in Spark) from a sample of documented size.

The insult terminals are a seed list extended by words that labelled rows prove:
found in at least ``least_support`` toxic texts and at most one clean text in
``odds`` as often; the size of the sample bounds how many there can be.

Defined cases: null and empty texts match nothing and score as clean; a clause may
hold several matches; of paths of equal weight the one with more matches of the earlier
constructions counts; runs of plain words longer than any reach read like shorter ones;
of several labels of an id the largest counts, null labels and ids are not learnt from.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import likely_smallest, small_batches
from .worker import FORGET, frugal

#: Terminals of the grammar.
INSULTS = (
    "idiot idiots moron morons stupid scum trash loser losers clown clowns pathetic worthless disgusting dumb imbecile fool filthy vermin "
    "idiota estúpido basura payaso inútil asqueroso idiote imbécile stupide ordure nul pathétique dégoûtant "
    "dumm idiotisch abschaum müll versager wertlos erbärmlich ekelhaft"
).split()
THREATS = "kill hurt destroy beat stab shoot punch attack burn matar golpear tuer frapper töten schlagen".split()
TARGETS = "you your yours they them he she him her we people tú usted ustedes vous tu toi du dich ihr sie".split()
NEGATIONS = "not no never isn't aren't wasn't don't didn't nobody nothing without nunca tampoco ne pas jamais sans nicht kein keine nie".split()
REPORTS = "said says wrote called reported quoted claimed stated dijo dice dit écrit sagte schrieb".split()

_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}'’]*|[\"“”«»„]|[.!?;:\n]")
_BOUNDARY = frozenset(".!?;:\n")
_QUOTE = frozenset("\"“”«»„")

PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, NEGATED, REPORTED = LABELS = range(9)
FEATURES = ("insult", "targeted", "threat", "negated", "reported")
#: What the matching transducer writes where nothing is matched.
NOTHING = -1
#: How far a negation or a target reaches, in words.
REACH = 4
#: Weights of the constructions on a path, and before any label is seen.
PRIOR = (4.0, 5.0, 5.0, 0.2, 0.2)
#: More matches of a construction count as this many.
CAP = 3

Arc = tuple[int, int, float]


@dataclass(frozen=True)
class Transducer:
    """By state and input label: arcs of next state, output label and weight.  State 0 is the start."""

    arcs: tuple[dict[int, tuple[Arc, ...]], ...]
    final: tuple[bool, ...]

    @classmethod
    def of(cls, start: object, table: dict[object, dict[int, list[tuple[object, int, float]]]], final: set) -> Transducer:
        """From arcs between named states."""
        number = {name: k for k, name in enumerate(sorted(table, key=lambda name: name != start))}
        arcs = [{label: tuple((number[to], out, w) for to, out, w in own) for label, own in table[name].items()} for name in number]
        return cls(tuple(arcs), tuple(name in final for name in number))

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this writes."""
        table, todo = {}, [(0, 0)]
        while todo:
            x, y = todo.pop()
            if (x, y) in table:
                continue
            own = table[x, y] = {
                label: [((to, on), out, w + v) for to, mid, w in arcs for on, out, v in other.arcs[y].get(mid, ())] for label, arcs in self.arcs[x].items()
            }
            todo += [name for arcs in own.values() for name, _, _ in arcs]
        return Transducer.of((0, 0), table, {(x, y) for x, y in table if self.final[x] and other.final[y]})

    def best(self, labels: tuple[int, ...], outputs: int) -> tuple[float, tuple[int, ...]]:
        """Weight of the best path over ``labels`` and how often it writes each of the outputs 0, 1, ..."""
        live: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, (0,) * outputs)}
        for label in labels:
            ahead: dict[int, tuple[float, tuple[int, ...]]] = {}
            for state, (weight, counts) in live.items():
                for to, out, w in self.arcs[state].get(label, ()):
                    found = (weight + w, counts if out == NOTHING else (*counts[:out], counts[out] + 1, *counts[out + 1 :]))
                    if to not in ahead or found > ahead[to]:
                        ahead[to] = found
            live = ahead
        return max((found for state, found in live.items() if self.final[state]), default=(-math.inf, (0,) * outputs))


def negation() -> Transducer:
    """State: how many words a negation still reaches."""
    table = {}
    for left in range(REACH + 1):
        after = max(0, left - 1)
        table[left] = {x: [(after, NEGATED if left and x in (INSULT, THREAT) else x, 0.0)] for x in LABELS} | {NEGATION: [(REACH, PLAIN, 0.0)]}
    return Transducer.of(0, table, set(table))


def reported_speech() -> Transducer:
    """State: whether a reporting verb came, and whether a quotation is open."""
    table = {}
    for said, quoted in ((a, b) for a in (False, True) for b in (False, True)):
        here = (said, quoted)
        table[here] = {x: [(here, REPORTED if any(here) and x in (INSULT, THREAT) else x, 0.0)] for x in LABELS}
        table[here] |= {REPORT: [((True, quoted), PLAIN, 0.0)], QUOTE: [((said, not quoted), PLAIN, 0.0)]}
    return Transducer.of((False, False), table, set(table))


def matching(weights: tuple[float, ...] = PRIOR) -> Transducer:
    """State: what waits for its other half, and for how many words yet."""
    insult, targeted, threat, negated, reported = range(len(FEATURES))
    idle, wait = ("idle", 0), {INSULT: (TARGET, targeted), THREAT: (TARGET, threat), TARGET: (INSULT, targeted)}
    alone = {INSULT: insult, NEGATED: negated, REPORTED: reported}
    passed = lambda x, to: (to, alone.get(x, NOTHING), weights[alone[x]] if x in alone else 0.0)
    table = {idle: {x: [passed(x, idle)] for x in LABELS}}
    for first, (second, out) in wait.items():
        table[idle][first].append(((first, REACH), NOTHING, 0.0))
        for left in range(1, REACH + 1):
            table[first, left] = {x: [passed(x, (first, left - 1))] if left > 1 else [] for x in LABELS}
            table[first, left][second].append((idle, out, weights[out]))
    # a target that found no insult was only passing
    return Transducer.of(idle, table, {idle, *((TARGET, left) for left in range(1, REACH + 1))})


@lru_cache(maxsize=1)
def clause_machine() -> Transducer:
    return negation().then(reported_speech()).then(matching())


@lru_cache(maxsize=50_000)
def transduce(clause: tuple[int, ...]) -> tuple[int, ...]:
    """How often the best path over a clause's labels holds each of ``FEATURES``."""
    return clause_machine().best(clause, len(FEATURES))[1]


FORGET["toxicity"] = transduce.cache_clear


@dataclass
class Grammar:
    """Terminals, weights of the constructions and an intercept."""

    extra: tuple[str, ...] = ()
    weights: tuple[float, ...] = PRIOR
    intercept: float = -4.0
    labels: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        for label, words in ((TARGET, TARGETS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (THREAT, THREATS), (INSULT, INSULTS), (INSULT, self.extra)):
            self.labels.update(dict.fromkeys(words, label))

    def clauses(self, text: str) -> Iterator[list[int]]:
        """Labels of each clause's words; of a run of plain words as many as any reach needs."""
        own: list[int] = []
        plain = 0
        for token in _TOKEN.findall(text):
            if token in _BOUNDARY:
                if own:
                    yield own
                own, plain = [], 0
            elif token in _QUOTE:
                own.append(QUOTE)
                plain = 0
            else:
                label = self.labels.get(token.lower().replace("’", "'"), PLAIN)
                plain = plain + 1 if label == PLAIN else 0
                if plain <= REACH + 1:
                    own.append(label)
        if own:
            yield own

    def matches(self, text: str | None) -> np.ndarray:
        """How often each construction of ``FEATURES`` is matched."""
        out = np.zeros(len(FEATURES))
        if text:
            for clause in self.clauses(text):
                if INSULT in clause or THREAT in clause:
                    out += transduce(tuple(clause))
        return out

    def score(self, counts: np.ndarray) -> float:
        z = self.intercept + sum(w * math.log1p(min(c, CAP)) for w, c in zip(self.weights, counts, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _match(shared: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar: Grammar = shared.value
        for batch in batches:
            counts = np.array([grammar.matches(t.as_py()) for t in batch.column("_text")]).reshape(-1, len(FEATURES))
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(counts[:, k].astype(np.int64)) for k in range(len(FEATURES))), pa.array([grammar.score(c) for c in counts], pa.float64())],
                [*names, *FEATURES, "score"],
            )

    return frugal(run, "toxicity")


def _matched(rows: DataFrame, names: list[str], grammar: Grammar) -> DataFrame:
    """``names`` of ``rows``, the matches of its _text, and the score."""
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(grammar)
    return rows.mapInArrow(_match(shared), ", ".join([*([schema] if names else []), *(f"{f} long" for f in FEATURES), "score double"]))


def match_clauses(documents: DataFrame, grammar: Grammar, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``keep``, the matches of each construction and the score."""
    names = [f"_k{k}" for k in range(len(keep))]
    rows = documents.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col(text_col).alias("_text"))
    return _matched(rows, names, grammar).toDF(*keep, *FEATURES, "score")


def without_toxic(documents: DataFrame, grammar: Grammar, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``documents`` that score less than ``threshold``, with all their columns."""
    names = [f"_k{k}" for k in range(len(documents.columns))]
    rows = documents.toDF(*names)
    rows = rows.withColumn("_text", F.col(names[documents.columns.index(text_col)]))
    return _matched(rows, names, grammar).where(F.col("score") < threshold).select(*names).toDF(*documents.columns)


def training_sample(documents: DataFrame, labels: DataFrame, limit: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(_text, toxic) of at most ``limit`` labelled documents, those of smallest hash.

    The bound is what makes the label side small enough to broadcast: no text is
    shuffled.  Of several labels for one id the largest counts.
    """
    known = likely_smallest(labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()), id_col, limit)
    ids = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("_toxic"))
    ids = ids.orderBy(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)), id_col).limit(limit)
    texts = documents.select(id_col, F.col(text_col).alias("_text"))
    return texts.join(F.broadcast(ids), id_col).select("_text", F.col("_toxic").alias("toxic"))


def learn_terms(labelled: DataFrame, least_support: int = 10, odds: int = 50) -> tuple[str, ...]:
    """Words that mark toxic texts; ``labelled`` has _text and toxic."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(r"(\p{L}[\p{L}\p{M}']*)"), 1))
    counts = labelled.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(
        F.sum(F.col("toxic")).alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    found = counts.where((F.col("bad") >= least_support) & (F.col("good") * odds <= F.col("bad")))
    return tuple(r[0] for r in found.orderBy(F.desc("bad"), "word").collect())


def fit(labelled: DataFrame, steps: int = 25, ridge: float = 0.05, **terms: int) -> Grammar:
    """A grammar for ``labelled`` (_text, toxic 0/1; other columns are ignored)."""
    rows = labelled.select("_text", F.col("toxic").cast("int").alias("toxic")).where("_text IS NOT NULL AND toxic IS NOT NULL")
    grammar = Grammar(extra=learn_terms(rows, **terms))
    capped = [F.least(F.col(f), F.lit(CAP)).alias(f) for f in FEATURES]
    matched = match_clauses(rows, grammar, ("toxic",), "_text").select("toxic", *capped)
    table = matched.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).collect()  # at most 4**5 rows
    if not table:
        return grammar
    x = np.array([[1.0, *(math.log1p(r[f]) for f in FEATURES)] for r in table])
    n, bad = np.array([float(r["n"]) for r in table]), np.array([float(r["bad"]) for r in table])
    prior = np.array([grammar.intercept, *grammar.weights])
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (bad - n * p) - ridge * (w - prior)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return Grammar(extra=grammar.extra, weights=tuple(w[1:]), intercept=float(w[0]))
