"""Shape fits, terrain guards, raster morphology and order-dependent merges."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grouped import Columns, each_group


def circle_moments(x: Column, y: Column) -> list[Column]:
    """Aggregates from which a circle follows: the points of a group never meet in one place."""
    q = x * x + y * y
    terms = {"n": F.count(x), "sx": F.sum(x), "sy": F.sum(y), "sxx": F.sum(x * x), "syy": F.sum(y * y), "sxy": F.sum(x * y), "sxq": F.sum(x * q), "syq": F.sum(y * q), "sqq": F.sum(q * q)}
    return [v.alias(f"_{k}") for k, v in terms.items()]


def fit_circles(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """(group, cx, cy, radius) of algebraic circle fits with Taubin's normalisation, null where it fails.

    Points are centred on their group's mean first, which keeps the moments small; the
    fit is the root of a cubic by Newton's method from zero.
    """
    mean = points.groupBy(group).agg(F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    centred = points.join(mean, group).select(group, "_mx", "_my", (F.col(x) - F.col("_mx")).alias("_x"), (F.col(y) - F.col("_my")).alias("_y"))
    moments = centred.groupBy(group, "_mx", "_my").agg(*circle_moments(F.col("_x"), F.col("_y")))

    def solve(batches):
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                v = dict(zip(rows.columns, r, strict=True))
                n = v["_n"]
                xx, yy, xy = v["_sxx"] / n, v["_syy"] / n, v["_sxy"] / n
                xq, yq, qq = v["_sxq"] / n, v["_syq"] / n, v["_sqq"] / n
                q = xx + yy
                det = xx * yy - xy * xy
                if n < 3 or det <= 1e-12:
                    out.append((v[group], None, None, None))
                    continue
                a3 = 4 * q
                a2 = -3 * q * q - qq
                a1 = (qq - q * q) * q + 4 * det * q - xq * xq - yq * yq
                a0 = xq * (xq * yy - yq * xy) + yq * (yq * xx - xq * xy) - (qq - q * q) * det
                root = 0.0
                for _ in range(50):
                    slope = a1 + root * (2 * a2 + root * 3 * a3)
                    step = (a0 + root * (a1 + root * (a2 + root * a3))) / slope if slope else 0.0
                    root -= step
                    if abs(step) < 1e-12 * max(1.0, abs(root)):
                        break
                below = 2 * (root * root - root * q + det)
                cx = (xq * (yy - root) - yq * xy) / below
                cy = (yq * (xx - root) - xq * xy) / below
                out.append((v[group], cx + v["_mx"], cy + v["_my"], float(np.sqrt(cx * cx + cy * cy + q))))
            yield pd.DataFrame(out, columns=[group, "cx", "cy", "radius"])

    return moments.mapInPandas(solve, f"{group} {points.schema[group].dataType.simpleString()}, cx double, cy double, radius double")


def guarded_heights(stations: DataFrame, key: str, order: str, height: str, jump: float) -> DataFrame:
    """(key, heights): each station's height, or its predecessor's where it would jump further than ``jump``.

    A fold over one camera's stations in order; missing heights repeat the last one.
    """
    rows = stations.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, height))).alias("_s"))
    last = lambda done: F.element_at(done, -1)

    def step(done: Column, s: Column) -> Column:
        h = s[height]
        bad = h.isNull() | (F.abs(h - last(done)) > jump)
        return F.concat(done, F.array(F.when((F.size(done) > 0) & bad, last(done)).otherwise(h)))

    empty = F.array().cast("array<double>")
    first = lambda done, s: F.when(F.size(done) == 0, F.array(s[height])).otherwise(step(done, s))
    return rows.select(key, F.aggregate("_s", empty, first).alias("heights"))


def best_annotator(scores: DataFrame, key: str, order: str, f1: str) -> DataFrame:
    """(key, best): left fold over annotators in order; a later one wins only with a strictly higher F1, or without one."""
    rows = scores.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, f1))).alias("_s"))
    pick = lambda best, s: F.when(best.isNull(), s).when(best[f1].isNull() | s[f1].isNull(), F.when(s[f1].isNull(), s).otherwise(best)).when(s[f1] > best[f1], s).otherwise(best)
    kind = rows.schema["_s"].dataType.elementType
    return rows.select(key, F.aggregate("_s", F.lit(None).cast(kind), pick).alias("_b")).select(key, F.col(f"_b.{order}").alias("best"))


def merge_boxes_to_fixpoint(boxes: DataFrame, group: str, box: list[str], score: str, limit: float) -> DataFrame:
    """(group, box, score, n): boxes that overlap by more than ``limit`` become their envelope with the best score, until none do.

    Envelopes grow, so that merging goes on; a group is one image's boxes.
    """
    kind = boxes.schema[group].dataType.simpleString()

    def run(rows: Columns) -> Columns:
        corners = np.stack([rows[c] for c in box], axis=1).astype(float).tolist()
        found = [(*b, float(s), 1) for b, s in zip(corners, rows[score], strict=True)]
        found.sort(key=lambda r: (-r[4], r[:4]))
        changed = True
        while changed:
            changed, done = False, []
            for r in found:
                for k, d in enumerate(done):
                    w, h = min(r[2], d[2]) - max(r[0], d[0]), min(r[3], d[3]) - max(r[1], d[1])
                    inter = max(w, 0.0) * max(h, 0.0)
                    union = (r[2] - r[0]) * (r[3] - r[1]) + (d[2] - d[0]) * (d[3] - d[1]) - inter
                    if union > 0 and inter / union > limit:
                        done[k] = (min(r[0], d[0]), min(r[1], d[1]), max(r[2], d[2]), max(r[3], d[3]), max(r[4], d[4]), r[5] + d[5])
                        changed = True
                        break
                else:
                    done.append(r)
            found = done
        made = np.array(found)
        return {**{c: made[:, k] for k, c in enumerate([*box, score])}, "n": made[:, 5].astype(np.int64)}

    return each_group(boxes, [group], [*box, score], run, f"{group} {kind}, {', '.join(f'{b} double' for b in box)}, {score} double, n long")


def clip_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area of the intersection of two convex polygons with corners in counter-clockwise order."""
    poly = a
    for p, q in zip(b, np.roll(b, -1, axis=0), strict=True):
        if not len(poly):
            return 0.0
        side = (q[0] - p[0]) * (poly[:, 1] - p[1]) - (q[1] - p[1]) * (poly[:, 0] - p[0])
        out = []
        for k in range(len(poly)):
            s, t, c, d = side[k], side[(k + 1) % len(poly)], poly[k], poly[(k + 1) % len(poly)]
            if s >= 0:
                out.append(c)
            if s * t < 0:
                out.append(c + (d - c) * (s / (s - t)))
        poly = np.array(out).reshape(-1, 2)
    if len(poly) < 3:
        return 0.0
    x, y = poly[:, 0], poly[:, 1]
    return float(abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2)


def rotated_corners(cx: float, cy: float, w: float, h: float, degrees: float) -> np.ndarray:
    t = np.radians(degrees)
    turn = np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
    return np.array([[-w, -h], [w, -h], [w, h], [-w, h]]) / 2 @ turn.T + (cx, cy)


def rotated_iou(pairs: DataFrame, left: list[str], right: list[str], keep: list[str]) -> DataFrame:
    """(keep, iou) of pairs of rotated boxes (cx, cy, w, h, degrees)."""
    head = ", ".join(f"{k} {pairs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches):
        for rows in batches:
            a, b = rows[left].to_numpy(dtype=float), rows[right].to_numpy(dtype=float)
            out = []
            for p, q in zip(a, b, strict=True):
                inter = clip_area(rotated_corners(*p), rotated_corners(*q))
                union = p[2] * p[3] + q[2] * q[3] - inter
                out.append(inter / union if union > 0 else 0.0)
            yield rows[keep].assign(iou=out)

    return pairs.select(*keep, *left, *right).mapInPandas(run, f"{head}, iou double")


def thin(mask: np.ndarray) -> np.ndarray:
    """One-pixel-wide skeleton by Zhang and Suen's two alternating passes."""
    m = np.pad(mask.astype(np.uint8), 1)
    while True:
        gone = 0
        for odd in (0, 1):
            n = [np.roll(m, s, (0, 1)) for s in ((1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1))]
            count = sum(x.astype(int) for x in n)
            turns = sum(((n[k] == 0) & (n[(k + 1) % 8] == 1)).astype(int) for k in range(8))
            a, b = ((n[0] * n[2] * n[4], n[2] * n[4] * n[6]) if odd == 0 else (n[0] * n[2] * n[6], n[0] * n[4] * n[6]))
            cut = (m == 1) & (count >= 2) & (count <= 6) & (turns == 1) & (a == 0) & (b == 0)
            m[cut] = 0
            gone += int(cut.sum())
        if not gone:
            return m[1:-1, 1:-1].astype(bool)


def distance_map(mask: np.ndarray) -> np.ndarray:
    """Exact Euclidean distance of every mask pixel to the nearest pixel outside; lower envelopes of parabolas by columns, then rows."""
    big = float(sum(mask.shape)) ** 2 + 1
    d = np.where(mask, big, 0.0)
    for axis in (0, 1):
        d = np.moveaxis(d, axis, 0)
        n = d.shape[0]
        gaps = (np.arange(n)[:, None] - np.arange(n)[None, :]) ** 2
        d = np.stack([(d + gaps[k][:, None]).min(axis=0) for k in range(n)])
        d = np.moveaxis(d, 0, axis)
    return np.sqrt(d)


def per_raster(pixels: DataFrame, key: str, x: str, y: str, function: str) -> DataFrame:
    """(key, x, y, value) of "thin" (skeleton pixels) or "distance" over each raster's mask pixels."""
    kind = pixels.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        px, py = rows[x].to_numpy(), rows[y].to_numpy()
        x0, y0 = px.min() - 1, py.min() - 1
        mask = np.zeros((py.max() - y0 + 2, px.max() - x0 + 2), dtype=bool)
        mask[py - y0, px - x0] = True
        values = thin(mask).astype(float) if function == "thin" else distance_map(mask)
        at = np.argwhere(values > 0)
        return pd.DataFrame({key: rows[key].iloc[0], x: at[:, 1] + x0, y: at[:, 0] + y0, "value": values[values > 0]})

    return pixels.select(key, x, y).groupBy(key).applyInPandas(run, f"{key} {kind}, {x} long, {y} long, value double")
