"""Vectorised word spans and rolling hashes over batches of whole texts.

A batch of texts is one byte buffer with offsets, as Arrow holds it.  Hashes are
polynomials modulo 2**64 with odd multipliers over well mixed units, so two given
different windows collide with probability 2**-64; where equality decides a
result, two such hashes with different multipliers form a 128-bit key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: Texts are worked on in runs of about this many bytes, which bounds the arrays.
RUN_BYTES = 1 << 19

#: Longer tables, as a very long text needs, are not kept.
KEPT_POWERS = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n-1 and the inverses modulo 2**64, kept and grown when needed."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= KEPT_POWERS:
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def text_runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any byte range follows."""
    p, _ = powers(BYTE_BASE, len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE_VALUES[data] * p[: len(data)], out=out[1:])
    return out


def byte_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inv = powers(BYTE_BASE, len(prefix) + 1)
    return mix((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True bytes that do not cross texts, and each text's first run."""
    n = len(inside)
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: True for bytes of words [^\x20\x09-\x0D]+.
PLAIN = np.ones(256, dtype=bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, index of each text's first word, and 64-bit word hashes."""
    starts, ends, first = spans(PLAIN[data], offsets)
    return starts, ends, first, byte_hash(byte_prefix(data), starts, ends)


def window_hash(units: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of the ``length`` units from each position; those that run over the end are left out."""
    n = len(units) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    p, inv = powers(base, len(units) + 1)
    s = np.zeros(len(units) + 1, dtype=U64)
    np.cumsum(units * p[: len(units)], out=s[1:])
    return mix((s[length:] - s[:-length]) * inv[:n])


def sliding(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, in time independent of ``width``."""
    n = len(values)
    if n < width:
        return values[:0]
    pad = -n % width
    edge = np.full(pad, np.iinfo(values.dtype).max if op is np.minimum else np.iinfo(values.dtype).min, dtype=values.dtype)
    blocks = np.concatenate([values, edge]).reshape(-1, width)
    forward = op.accumulate(blocks, axis=1).ravel()
    backward = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(backward[: n - width + 1], forward[width - 1 : n])
