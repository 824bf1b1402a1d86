"""Packing and sampling of training examples."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def pack_blocks(rows: DataFrame, block: str, ident: str, size: str, capacity: int) -> DataFrame:
    """(block, ident, size, bin): best-fit decreasing within each block; items over the capacity stand alone.

    A block holds a bounded number of items, so a group is small whatever the input.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([size, ident], ascending=[False, True])
        room: list[float] = []
        bins = []
        for s in group[size]:
            fits = [(r - s, k) for k, r in enumerate(room) if r >= s]
            k = min(fits)[1] if fits else len(room)
            if not fits:
                room.append(capacity)
            room[k] -= s
            bins.append(k)
        return group.assign(bin=bins)[[block, ident, size, "bin"]]

    return rows.select(block, ident, size).groupBy(block).applyInPandas(pack, f"{block} {kinds[block]}, {ident} {kinds[ident]}, {size} {kinds[size]}, bin long")
