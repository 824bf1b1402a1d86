"""Minimum-cost one-to-one assignment."""

from __future__ import annotations

import numpy as np


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs of a minimum-cost matching that covers the smaller side.

    Shortest augmenting paths with potentials, O(rows² · columns); non-finite costs count as
    prohibitively large.
    """
    if cost.size == 0:
        return []
    cost = np.where(np.isfinite(cost), cost, 1e12).astype(np.float64)
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assign(cost.T))
    n, m = cost.shape
    by_row, by_column = np.zeros(n), np.zeros(m)
    owner = np.full(m, -1)
    for start in range(n):
        reach, previous, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, dtype=bool)
        row, column = start, -1
        while True:
            slack = cost[row] - by_row[row] - by_column
            base = 0.0 if column < 0 else reach[column]
            better = ~done & (base + slack < reach - 1e-15)
            reach[better], previous[better] = base + slack[better], column
            open_reach = np.where(done, np.inf, reach)
            column = int(np.argmin(open_reach))
            done[column] = True
            if owner[column] < 0:
                break
            row = owner[column]
        final = reach[column]
        seen = done.copy()
        seen[column] = False
        by_row[start] += final
        for c in np.flatnonzero(seen):
            by_row[owner[c]] += final - reach[c]
            by_column[c] -= final - reach[c]
        while column >= 0:
            before = previous[column]
            owner[column] = start if before < 0 else owner[before]
            column = before
    return sorted((int(owner[c]), c) for c in range(m) if owner[c] >= 0)
