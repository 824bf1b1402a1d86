"""What Python workers hold between tasks.

Spark reuses its workers, so what one operator keeps in memory would stay while others run.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

Map = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: How to forget what the functions of a name keep.
FORGET: dict[str, Callable[[], None]] = {}


def frugal(run: Map, keeps: str = "") -> Map:
    """``run``, which starts without what functions of other names keep and gives freed memory back at its end."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, forget in FORGET.items():
            if name != keeps:
                forget()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return wrapped
