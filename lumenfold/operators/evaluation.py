"""Detection and tracking evaluation: matching within groups, metrics by aggregation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenfold.functions.assignment import assign

from .grouped import Columns, each_group


def hungarian(pairs: DataFrame, keys: list[str], left: str, right: str, score: str) -> DataFrame:
    """(keys, left, right, score): the one-to-one matching of largest summed score in each group.

    A group is one image or time step, whose size the data model bounds.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def match(group: Columns) -> Columns:
        rows, at_row = np.unique(group[left], return_inverse=True)
        columns, at_column = np.unique(group[right], return_inverse=True)
        grid, has = np.zeros((len(rows), len(columns))), np.zeros((len(rows), len(columns)), dtype=bool)
        grid[at_row, at_column], has[at_row, at_column] = group[score], True
        found = [(r, c) for r, c in assign(-grid) if has[r, c]]
        r, c = np.array([x for x, _ in found], dtype=int), np.array([x for _, x in found], dtype=int)
        return {left: rows[r], right: columns[c], score: grid[r, c]}

    return each_group(pairs, keys, [left, right, score], match, ", ".join(f"{c} {kinds[c]}" for c in [*keys, left, right, score]))


def greedy_keep(boxes: DataFrame, keys: list[str], ident: str, score: str, box: list[str], limit: float, mode: str = "iou", at_limit: bool = False) -> DataFrame:
    """Greedy suppression by falling score (lowest id first on ties): a box goes if it overlaps a kept one by more than ``limit``.

    Order-dependent, hence one NumPy pass per image; ``mode`` "iom" divides by the
    smaller area; ``at_limit`` lets an overlap of just ``limit`` suppress, too.
    """

    def keep(group: Columns) -> Columns:
        order = np.lexsort((group[ident], -group[score]))
        b = np.stack([group[c][order] for c in box], axis=1).astype(np.float64)
        area = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
        alive, kept = np.ones(len(b), dtype=bool), []
        for i in range(len(b)):
            if not alive[i]:
                continue
            kept.append(i)
            w = np.minimum(b[i, 2], b[:, 2]) - np.maximum(b[i, 0], b[:, 0])
            h = np.minimum(b[i, 3], b[:, 3]) - np.maximum(b[i, 1], b[:, 1])
            inter = np.clip(w, 0, None) * np.clip(h, 0, None)
            below = np.minimum(area[i], area) if mode == "iom" else area[i] + area - inter
            alive &= ~(inter >= limit * below if at_limit else inter > limit * below)
        return {c: group[c][order[kept]] for c in names}

    names = [c for c in boxes.columns if c not in keys]
    kinds = {f.name: f.dataType.simpleString() for f in boxes.schema}
    return each_group(boxes, keys, names, keep, ", ".join(f"{c} {kinds[c]}" for c in boxes.columns))


def threshold_counts(matched: DataFrame, keys: list[str], score: str, n_left: str, n_right: str, thresholds: list[float]) -> DataFrame:
    """(keys, threshold, tp, fp, fn) from matched scores (null for none) and the group's counts on both sides."""
    rows = matched.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    out = rows.groupBy(*keys, "threshold").agg(
        F.sum((F.coalesce(F.col(score), F.lit(-1.0)) >= F.col("threshold")).cast("long")).alias("tp"), F.max(n_left).alias("_l"), F.max(n_right).alias("_r")
    )
    return out.select(*keys, "threshold", "tp", (F.col("_r") - F.col("tp")).alias("fp"), (F.col("_l") - F.col("tp")).alias("fn"))


def classification_f1(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Micro precision, recall, F1 over summed counts, image-level MCC from il_* columns, and their product."""
    s = counts.groupBy(*keys).agg(*(F.sum(c).cast("double").alias(c) for c in ("tp", "fp", "fn", "il_tp", "il_fp", "il_fn", "il_tn")))
    p, r = F.col("tp") / (F.col("tp") + F.col("fp") + 1e-4), F.col("tp") / (F.col("tp") + F.col("fn") + 1e-4)
    root = F.sqrt((F.col("il_tp") + F.col("il_fp")) * (F.col("il_tp") + F.col("il_fn")) * (F.col("il_tn") + F.col("il_fp")) * (F.col("il_tn") + F.col("il_fn")))
    mcc = (F.col("il_tp") * F.col("il_tn") - F.col("il_fp") * F.col("il_fn")) / (root + 1e-6)
    out = s.withColumns({"precision": p, "recall": r, "mcc": mcc}).withColumn("f1", 2 * p * r / (p + r + 1e-4))
    return out.select(*keys, "precision", "recall", "f1", "mcc", (F.col("f1") * F.col("mcc")).alias("cgf1"))


def average_precision(hits: DataFrame, keys: list[str], score: str, ident: str, hit: str, positives: DataFrame) -> DataFrame:
    """AP at 101 recall points: cumulative counts by falling score, precision made monotone from the right."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*keys).orderBy(F.asc(score), F.desc(ident)).rowsBetween(Window.unboundedPreceding, 0)  # a running maximum from the end
    rows = hits.withColumns({"_tp": F.sum(F.col(hit).cast("long")).over(upto), "_n": F.row_number().over(w)}).join(positives, keys)
    rows = rows.withColumns({"_r": F.col("_tp") / F.col("n_pos"), "_p": F.col("_tp") / F.col("_n")})
    rows = rows.withColumn("_e", F.max("_p").over(onward))
    # the recall points that a row is the first to reach
    before = F.coalesce(F.lag("_r").over(w), F.lit(-1.0))
    points = F.floor(F.col("_r") * 100 + 1e-9) - F.floor(before * 100 + 1e-9)
    points = F.when(before < 0, F.floor(F.col("_r") * 100 + 1e-9) + 1).otherwise(points)
    return rows.withColumn("_k", points).groupBy(*keys).agg((F.sum(F.col("_k") * F.col("_e")) / 101).alias("ap"))


def track_iou(left: DataFrame, right: DataFrame, frame: str, left_area: str, right_area: str, inter: str) -> DataFrame:
    """(l, r, iou): summed intersections over summed unions; frames with one side add its area."""
    both = left.join(right, ["l", "r", frame], "full_outer")
    i, a, b = (F.coalesce(F.col(c), F.lit(0.0)) for c in (inter, left_area, right_area))
    sums = both.groupBy("l", "r").agg(F.sum(i).alias("_i"), F.sum(a + b - i).alias("_u"))
    return sums.select("l", "r", F.when(F.col("_u") > 0, F.col("_i") / F.col("_u")).otherwise(F.lit(1.0)).alias("iou"))


def _hota(group: pd.DataFrame, alphas: np.ndarray) -> Iterator[tuple]:
    """(alpha, tp, fn, fp, loc, ass) of one sequence; rows: t, gt, trk, sim with null for one-sided detections."""
    gts, trks = sorted(group["gt"].dropna().unique()), sorted(group["trk"].dropna().unique())
    g, k = {v: i for i, v in enumerate(gts)}, {v: i for i, v in enumerate(trks)}
    n_gt, n_trk = np.zeros(len(gts)), np.zeros(len(trks))
    potential = np.zeros((len(gts), len(trks)))
    steps = []
    for _, rows in group.groupby("t"):
        own_g = sorted(rows["gt"].dropna().unique())
        own_k = sorted(rows["trk"].dropna().unique())
        sim = np.zeros((len(own_g), len(own_k)))
        for a, b, s in zip(rows["gt"], rows["trk"], rows["sim"], strict=True):
            if pd.notna(a) and pd.notna(b):
                sim[own_g.index(a), own_k.index(b)] = s
        ig, ik = [g[a] for a in own_g], [k[b] for b in own_k]
        below = sim.sum(0, keepdims=True) + sim.sum(1, keepdims=True) - sim
        share = np.divide(sim, below, out=np.zeros_like(sim), where=below > 1e-12)
        potential[np.ix_(ig, ik)] += share
        n_gt[ig] += 1
        n_trk[ik] += 1
        steps.append((ig, ik, sim))
    alignment = potential / np.maximum(n_gt[:, None] + n_trk[None, :] - potential, 1e-12)
    matches = []
    tp, loc = np.zeros(len(alphas)), np.zeros(len(alphas))
    together = np.zeros((len(alphas), len(gts), len(trks)))
    for ig, ik, sim in steps:
        found = assign(-(alignment[np.ix_(ig, ik)] * sim)) if sim.size else []
        matches.append(found)
        for r, c in found:
            ok = sim[r, c] >= alphas - 1e-12
            tp += ok
            loc += ok * sim[r, c]
            together[ok, ig[r], ik[c]] += 1
    for x, alpha in enumerate(alphas):
        union = np.maximum(n_gt[:, None] + n_trk[None, :] - together[x], 1e-12)
        ass = float((together[x] * together[x] / union).sum())
        yield float(alpha), float(tp[x]), float(n_gt.sum() - tp[x]), float(n_trk.sum() - tp[x]), float(loc[x]), ass / max(tp[x], 1.0)


def hota(tracks: DataFrame, keys: list[str]) -> DataFrame:
    """Per sequence and alpha: tp, fn, fp, det_a, ass_a, loc_a and hota.  ``tracks``: keys, t, gt, trk, sim."""
    alphas = np.arange(1, 20) / 20
    kinds = {f.name: f.dataType.simpleString() for f in tracks.schema}

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(list(_hota(group, alphas)), columns=["alpha", "tp", "fn", "fp", "loc", "ass_a"])
        for k in keys:
            out[k] = group[k].iloc[0]
        return out[[*keys, "alpha", "tp", "fn", "fp", "loc", "ass_a"]]

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "alpha double, tp double, fn double, fp double, loc double, ass_a double"])
    rows = tracks.groupBy(*keys).applyInPandas(run, schema)
    det = F.col("tp") / F.greatest(F.col("tp") + F.col("fn") + F.col("fp"), F.lit(1.0))
    rows = rows.withColumn("det_a", det).withColumn("loc_a", F.when(F.col("tp") > 0, F.col("loc") / F.col("tp")).otherwise(F.lit(1.0)))
    return rows.withColumn("hota", F.sqrt(F.col("det_a") * F.col("ass_a"))).drop("loc")


def combine_hota(parts: DataFrame) -> DataFrame:
    """Sequences combined per alpha: sums of counts, association weighted by true positives."""
    s = parts.groupBy("alpha").agg(
        F.sum("tp").alias("tp"), F.sum("fn").alias("fn"), F.sum("fp").alias("fp"), (F.sum(F.col("ass_a") * F.col("tp")) / F.greatest(F.sum("tp"), F.lit(1.0))).alias("ass_a")
    )
    s = s.withColumn("det_a", F.col("tp") / F.greatest(F.col("tp") + F.col("fn") + F.col("fp"), F.lit(1.0)))
    return s.withColumn("hota", F.sqrt(F.col("det_a") * F.col("ass_a")))
