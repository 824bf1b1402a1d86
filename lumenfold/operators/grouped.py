"""Order-dependent work on very many small groups without a pandas call for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Columns = dict[str, np.ndarray]


def each_group(rows: DataFrame, keys: list[str], columns: list[str], function: Callable[[Columns], Columns], schema: str) -> DataFrame:
    """``function`` on the columns of each group, in one pass over sorted partitions.

    It gets NumPy columns and returns those of ``schema`` that are no keys; the keys are
    repeated for each row it returns.  Only the group that a batch ends in is held over.
    """
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    own = [n for n in names if n not in keys]

    def finish(parts: list[tuple[tuple, Columns]]) -> pa.RecordBatch | None:
        made = [(k, function(c)) for k, c in parts]
        sizes = [len(m[own[0]]) for _, m in made]
        if not sum(sizes):
            return None
        out = {n: np.concatenate([m[n] for _, m in made]) for n in own}
        out |= {k: np.repeat(np.array([key[x] for key, _ in made]), sizes) for x, k in enumerate(keys)}
        return pa.RecordBatch.from_arrays([pa.array(out[n]) for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Columns | None = None
        for batch in batches:
            got = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in dict.fromkeys([*keys, *columns])}
            if not batch.num_rows:
                continue
            if held is not None:
                got = {c: np.concatenate([held[c], got[c]]) for c in got}
            n = len(got[keys[0]])
            new = np.zeros(n, dtype=bool)
            for k in keys:
                new[1:] |= got[k][1:] != got[k][:-1]
            starts = np.concatenate([[0], np.flatnonzero(new)])
            parts = [(tuple(got[k][a] for k in keys), {c: got[c][a:b] for c in columns}) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            held = {c: got[c][starts[-1] :] for c in got}
            if parts and (made := finish(parts)) is not None:
                yield made
        if held is not None and (made := finish([(tuple(held[k][0] for k in keys), {c: held[c] for c in columns})])) is not None:
            yield made

    sorted_rows = rows.select(*dict.fromkeys([*keys, *columns])).repartition(*keys).sortWithinPartitions(*keys)
    return sorted_rows.mapInArrow(run, schema)
