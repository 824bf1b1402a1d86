"""Road graphs from skeleton pixels: critical pixels, clustered junctions, traced paths, spur pruning."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

Pixel = tuple[int, int]
AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]


def neighbours_of(pixels: set[Pixel]) -> dict[Pixel, list[Pixel]]:
    """Eight-neighbour adjacency; a diagonal step beside a straight one is left out, so that corners are no junctions."""
    out = {}
    for x, y in pixels:
        own = [(x + i, y + j) for i, j in AROUND if (x + i, y + j) in pixels]
        straight = {(a, b) for a, b in own if a == x or b == y}
        out[x, y] = [(a, b) for a, b in own if (a, b) in straight or ((a, y) not in straight and (x, b) not in straight)]
    return out


def trace(pixels: set[Pixel]) -> tuple[dict[Pixel, str], list[tuple[Pixel, Pixel, list[Pixel]]]]:
    """(nodes with their kind, edges with their pixels): a junction is the smallest pixel of a cluster of branching ones."""
    near = neighbours_of(pixels)
    branching = {p for p in pixels if len(near[p]) >= 3}
    cluster: dict[Pixel, Pixel] = {}
    for p in sorted(branching):
        if p in cluster:
            continue
        stack = [p]
        while stack:
            q = stack.pop()
            if q not in cluster:
                cluster[q] = p
                stack += [r for r in near[q] if r in branching]
    nodes = {p: "junction" for p in cluster.values()} | {p: "endpoint" for p in pixels if len(near[p]) == 1}
    name = lambda p: cluster.get(p, p)
    edges, used = [], set()
    for start in sorted([p for p in pixels if p in branching or p in nodes]):
        for step in sorted(near[start]):
            if (start, step) in used or (step in branching and name(step) == name(start)):
                continue
            path = [start, step]
            while path[-1] not in branching and len(near[path[-1]]) == 2:
                a, b = near[path[-1]]
                path.append(b if a == path[-2] else a)
                if path[-1] == start:
                    break
            used |= {(start, step), (path[-1], path[-2])}
            edges.append((name(start), name(path[-1]), path))
    return nodes, edges


def length_of(path: list[Pixel]) -> float:
    return sum(((a - c) ** 2 + (b - d) ** 2) ** 0.5 for (a, b), (c, d) in zip(path[:-1], path[1:], strict=True))


def pruned(pixels: set[Pixel], shortest: float, rounds: int = 10) -> set[Pixel]:
    """Without spurs: branches from an endpoint to a junction shorter than ``shortest``, until none or ``rounds`` are over."""
    for _ in range(rounds):
        nodes, edges = trace(pixels)
        gone: set[Pixel] = set()
        for u, v, path in edges:
            kinds = {nodes.get(u), nodes.get(v)}
            if kinds == {"endpoint", "junction"} and length_of(path) < shortest:
                inner = path if nodes.get(path[0]) == "endpoint" else path[::-1]
                gone |= set(inner[:-1])
        if not gone:
            break
        pixels = pixels - gone
    return pixels


def road_edges(skeleton: DataFrame, key: str, x: str = "x", y: str = "y", shortest: float = 0.0) -> DataFrame:
    """(key, ux, uy, vx, vy, length, n): the edges of each raster's graph after pruning; a raster is one tile."""
    kind = skeleton.schema[key].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        pixels = pruned(set(zip(rows[x].tolist(), rows[y].tolist(), strict=True)), shortest)
        found = [(*u, *v, length_of(path), len(path)) for u, v, path in trace(pixels)[1]]
        out = pd.DataFrame(found, columns=["ux", "uy", "vx", "vy", "length", "n"])
        out.insert(0, key, rows[key].iloc[0])
        return out

    return skeleton.select(key, x, y).groupBy(key).applyInPandas(run, f"{key} {kind}, ux long, uy long, vx long, vy long, length double, n long")
