"""URL verdicts: longest-match rules first, gradient-boosted trees elsewhere.

Rules (``host/path prefix``) allow or block.  The URLs that they decide are the
labelled ones: a bounded, deterministic sample of them (``sample_urls`` distinct URLs
of smallest hash) trains the trees, which judge what no rule fits.  Features are
lexical: lengths, depth, digit ratio, entropy, parameter counts, and smoothed block
rates and frequencies of host suffixes and leading path segments, out of fold.  In a
second copy of the sample some suffixes count as unknown, so the trees learn to judge a
suffix that no rule has decided by the form of the URL.

Judging is one map over the pages with rules and trees broadcast (a few hundred
nodes).  Only the URL column is read.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule
and is judged by its features like any other; where the labelled URLs are not of both
kinds there is nothing to learn from, and what no rule fits is allowed; rules of equal
length cannot both fit a URL unless they are the same.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import likely_smallest, small_batches
from .worker import frugal

ALLOW, BLOCK = "allow", "block"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, rest): after the first ``://`` up to ``/``, ``?``, ``#``; up to ``?``, ``#``; what follows."""
    if url is None or (at := url.find("://")) < 0:
        return "", "", ""
    rest = url[at + 3 :]
    end = min((k for c in "/?#" if (k := rest.find(c)) >= 0), default=len(rest))
    stop = min((k for c in "?#" if (k := rest.find(c)) >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:stop] if stop > end else "", rest[stop:]


@dataclass
class Rules:
    """``{"net/es/": "block"}``: host with its subdomains, and the start of the path."""

    verdicts: dict[str, str]
    by_host: dict[str, list[tuple[str, str]]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        for rule in sorted(self.verdicts, key=len, reverse=True):
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule))

    def match(self, host: str, path: str) -> str | None:
        best = None
        while host:
            found = next((r for start, r in self.by_host.get(host, ()) if path.startswith(start)), None)
            if found and (best is None or len(found) > len(best)):
                best = found
            _, _, host = host.partition(".")
        return best


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def suffixes(host: str, path: str) -> tuple[str, str, str]:
    """Last label, last two labels, first path segment."""
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:]), "/" + path.split("/")[1] if "/" in path else ""


@dataclass
class Lexicon:
    """Block rates and frequencies of suffixes in the labelled sample."""

    prior: float = 0.5
    seen: dict[tuple[int, str], tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def learn(cls, parts: list[tuple[str, str]], blocked: np.ndarray) -> Lexicon:
        seen: dict[tuple[int, str], list[int]] = {}
        for (host, path), b in zip(parts, blocked, strict=True):
            for kind, s in enumerate(suffixes(host, path)):
                own = seen.setdefault((kind, s), [0, 0])
                own[0] += 1
                own[1] += int(b)
        prior = float(blocked.mean()) if len(blocked) else 0.5
        return cls(prior, {k: (a, b) for k, (a, b) in seen.items()})

    def features(self, url: str | None, unknown: tuple[bool, ...] = (False,) * 3) -> list[float]:
        """Of a URL, whose suffixes marked in ``unknown`` are treated as never seen."""
        url = url or ""
        host, path, rest = split_url(url)
        n = len(url)
        out = [
            n, len(host), len(path), path.count("/"), host.count("."), host.count("-"), entropy(host), entropy(url),
            sum(c.isdigit() for c in url) / n if n else 0.0, sum(c.isdigit() for c in path), url.count("%"), url.count("_") + path.count("-"),
            (rest.count("&") + 1 if "?" in rest else 0), rest.count("="), float("#" in rest), float(url[:5] == "https"),
            float("." in path.rsplit("/", 1)[-1]), float(path.endswith("/")), max((len(x) for x in host.split(".")), default=0), float(host.startswith("www.")),
        ]
        for hidden, (kind, s) in zip(unknown, enumerate(suffixes(host, path)), strict=True):
            rows, bad = (0, 0) if hidden else self.seen.get((kind, s), (0, 0))
            out += [(bad + 10 * self.prior) / (rows + 10), math.log1p(rows)]
        return [float(x) for x in out]


#: Parts of the sample; a URL's suffix rates come from the other parts.
FOLDS = 5


def training_features(urls: list[str], blocked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels: each URL with the suffix rates of other folds, once as they are and once with some of its suffixes hidden.

    A model that always knew the suffixes would learn nothing about those it has never seen.
    """
    parts = [split_url(u)[:2] for u in urls]
    draw = np.array([zlib.crc32(u.encode("utf-8", "surrogatepass")) for u in urls])
    fold = draw % FOLDS
    lexicons = [Lexicon.learn([p for p, own in zip(parts, fold, strict=True) if own != f], blocked[fold != f]) for f in range(FOLDS)]
    hidden = [tuple(bool(d >> (8 + 3 * k) & 1) for k in range(3)) for d in draw]
    known = [lexicons[f].features(u) for u, f in zip(urls, fold, strict=True)]
    masked = [lexicons[f].features(u, h) for u, f, h in zip(urls, fold, hidden, strict=True)]
    return np.array(known + masked), np.concatenate([blocked, blocked])


@dataclass
class Tree:
    """A depth-first array tree: feature < 0 marks a leaf."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for own, x in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            own.append(x)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = (np.array(a) for a in (self.feature, self.cut, self.left, self.right, self.value))
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(feature)):
            live = np.flatnonzero(feature[node] >= 0)
            if not len(live):
                break
            own = node[live]
            node[live] = np.where(x[live, feature[own]] <= cut[own], left[own], right[own])
        return value[node]


@dataclass
class BoostedTrees:
    """Logistic gradient boosting with second-order leaf values over quantile-binned features."""

    rounds: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    least_leaf: int = 10
    ridge: float = 1.0
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 1e-3
        self.base = math.log(rate / (1 - rate))
        if len(y) == 0 or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        z = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            tree = Tree()
            self._grow(tree, tree.add(), binned, edges, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            z += tree.predict(x)
        return self

    def _grow(self, tree: Tree, node: int, binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        tree.value[node] = float(self.rate * total_g / (total_h + self.ridge))
        if depth == 0 or len(rows) < 2 * self.least_leaf:
            return
        best = (1e-6, -1, -1)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            own = binned[rows, f]
            left_g, left_h, left_n = (np.cumsum(np.bincount(own, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
            gain = left_g**2 / (left_h + self.ridge) + (total_g - left_g) ** 2 / (total_h - left_h + self.ridge) - total_g**2 / (total_h + self.ridge)
            gain[(left_n < self.least_leaf) | (len(rows) - left_n < self.least_leaf)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
        if best[1] < 0:
            return
        _, f, k = best
        go = binned[rows, f] <= k
        tree.feature[node], tree.cut[node] = f, float(edges[f][k])
        tree.left[node], tree.right[node] = tree.add(), tree.add()
        self._grow(tree, tree.left[node], binned, edges, g, h, rows[go], depth - 1)
        self._grow(tree, tree.right[node], binned, edges, g, h, rows[~go], depth - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for tree in self.trees:
            z += tree.predict(x)
        return 1 / (1 + np.exp(-z))


@dataclass
class UrlModel:
    lexicon: Lexicon
    trees: BoostedTrees

    def score(self, urls: list[str | None]) -> np.ndarray:
        if not urls:
            return np.zeros(0)
        return self.trees.score(np.array([self.lexicon.features(u) for u in urls]))


def _rule_of(shared: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: Rules = shared.value
        for batch in batches:
            found = [rules.match(*split_url(u)[:2]) for u in batch.column("_url").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_url"), pa.array(found, pa.string())], ["_url", "_rule"])

    return frugal(run)


def fit_url_model(pages: DataFrame, rules: Rules, sample_urls: int = 20_000, url_col: str = "url") -> UrlModel:
    """Trees trained on at most ``sample_urls`` of the distinct URLs that ``rules`` decide."""
    shared = pages.sparkSession.sparkContext.broadcast(rules)
    urls = pages.select(F.col(url_col).alias("_url")).where("_url IS NOT NULL")
    near = likely_smallest(urls, "_url", sample_urls)
    decided = near.mapInArrow(_rule_of(shared), "_url string, _rule string").where("_rule IS NOT NULL").distinct()
    sample = decided.orderBy(F.pmod(F.xxhash64("_url"), F.lit(1 << 30)), "_url").limit(sample_urls).collect()
    urls = [u for u, _ in sample]
    blocked = np.array([rules.verdicts[r] == BLOCK for _, r in sample], dtype=np.float64)
    if not sample or blocked.min() == blocked.max():
        return UrlModel(Lexicon(), BoostedTrees().fit(np.zeros((0, 0)), np.zeros(0)))
    return UrlModel(Lexicon.learn([split_url(u)[:2] for u in urls], blocked), BoostedTrees().fit(*training_features(urls, blocked)))


def _judge(shared: object, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, model = shared.value
        for batch in batches:
            urls = batch.column("_url").to_pylist()
            parts = [split_url(u) for u in urls]
            rule = [rules.match(h, p) for h, p, _ in parts]
            score = model.score(urls)
            verdict = [rules.verdicts[r] if r else BLOCK if s >= threshold else ALLOW for r, s in zip(rule, score, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array([h for h, _, _ in parts], pa.string()),
                    pa.array([p for _, p, _ in parts], pa.string()),
                    pa.array(rule, pa.string()),
                    pa.array(verdict, pa.string()),
                    pa.array(score, pa.float64()),
                ],
                ["_id", "host", "path", "rule", "verdict", "score"],
            )

    return frugal(run)


def judge_urls(pages: DataFrame, rules: Rules, model: UrlModel, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict and the trees' block score."""
    kind = pages.schema[id_col].dataType.simpleString()
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((rules, model))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    found = rows.mapInArrow(_judge(shared, threshold), f"_id {kind}, host string, path string, rule string, verdict string, score double")
    return found.withColumnRenamed("_id", id_col)
