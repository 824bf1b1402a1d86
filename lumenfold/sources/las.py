"""LAS point clouds as a Python data source, read by record ranges and written back.

``spark.read.format("las").load(path)`` gives scene_id, pid, x, y, z, r, g, b, intensity
and, if the file declares it, cls_id.  Files are read through the ranges that
``recordsPerPartition`` cuts, so one large file is many tasks.  Format: LAS 1.2, point
formats 0 to 3, little-endian.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Bytes of a record in point formats 0 to 3, and where its colours stand.
RECORD_BYTES = (20, 28, 26, 34)
COLOUR_AT = (None, None, 20, 28)
HEADER_BYTES = 227
SCHEMA = "scene_id string, pid int, x double, y double, z double, r short, g short, b short, intensity short"


@dataclass
class Header:
    offset: int
    form: int
    size: int
    count: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]


def read_header(path: str) -> Header:
    with open(path, "rb") as f:
        raw = f.read(HEADER_BYTES)
    if raw[:4] != b"LASF":
        raise ValueError(f"{path} is no LAS file")
    offset = struct.unpack_from("<I", raw, 96)[0]
    form, size, count = struct.unpack_from("<BHI", raw, 104)
    if form > 3:
        raise ValueError(f"point format {form} is not supported")
    numbers = struct.unpack_from("<6d", raw, 131)
    return Header(offset, form, size, count, numbers[:3], numbers[3:])


def read_records(path: str, head: Header, first: int, count: int) -> dict[str, np.ndarray]:
    """Coordinates, colours and intensity of ``count`` records; 16-bit values come back as 8-bit."""
    raw = np.fromfile(path, dtype=np.uint8, count=count * head.size, offset=head.offset + first * head.size).reshape(-1, head.size)
    xyz = raw[:, :12].copy().view("<i4").astype(np.float64) * head.scale + head.shift
    out = {"pid": np.arange(first, first + len(raw), dtype=np.int32), "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2]}
    at = COLOUR_AT[head.form]
    colours = raw[:, at : at + 6].copy().view("<u2") if at else np.zeros((len(raw), 3), dtype=np.uint16)
    for k, name in enumerate("rgb"):
        out[name] = colours[:, k]
    out["intensity"] = raw[:, 12:14].copy().view("<u2")[:, 0]
    return out


def wide_values(path: str, head: Header) -> tuple[bool, bool]:
    """Whether the file's colours and intensities exceed 255, in one pass over its records."""
    colour = bright = False
    for first in range(0, head.count, 1 << 20):
        part = read_records(path, head, first, min(1 << 20, head.count - first))
        colour |= any(int(part[c].max(initial=0)) > 255 for c in "rgb")
        bright |= int(part["intensity"].max(initial=0)) > 255
    return colour, bright


@dataclass
class LasRange(InputPartition):
    path: str
    first: int
    count: int


class LasReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.step = int(options.get("recordsPerPartition", 1 << 20))

    def partitions(self) -> list[LasRange]:
        files = sorted(glob.glob(os.path.join(self.path, "*.las"))) if os.path.isdir(self.path) else [self.path]
        out = []
        for f in files:
            count = read_header(f).count
            out += [LasRange(f, k, min(self.step, count - k)) for k in range(0, count, self.step)]
        return out

    def read(self, part: LasRange) -> Iterator[pa.RecordBatch]:
        head = read_header(part.path)
        colour, bright = wide_values(part.path, head)
        got = read_records(part.path, head, part.first, part.count)
        for name in "rgb":
            got[name] = (got[name] // 256 if colour else got[name]).astype(np.int16)
        got["intensity"] = (got["intensity"] // 256 if bright else got["intensity"]).astype(np.int16)
        scene = os.path.splitext(os.path.basename(part.path))[0]
        names = ["pid", "x", "y", "z", "r", "g", "b", "intensity"]
        yield pa.RecordBatch.from_arrays([pa.array([scene] * len(got["pid"])), *(pa.array(got[n]) for n in names)], ["scene_id", *names])


@dataclass
class Written(WriterCommitMessage):
    path: str
    count: int


class LasWriter(DataSourceWriter):
    """One file a task, point format 2, under a folder that all tasks share."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.scale = float(options.get("scale", 0.001))

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        found = [(r.x, r.y, r.z, r.intensity or 0, r.r or 0, r.g or 0, r.b or 0) for r in rows]
        path = os.path.join(self.path, f"part-{TaskContext.get().partitionId():05d}.las")
        table = np.array(found, dtype=np.float64).reshape(-1, 7)
        low = table[:, :3].min(axis=0) if len(table) else np.zeros(3)
        high = table[:, :3].max(axis=0) if len(table) else np.zeros(3)
        record = np.zeros(len(table), dtype=[("xyz", "<i4", 3), ("i", "<u2"), ("rest", "u1", 6), ("rgb", "<u2", 3)])
        record["xyz"] = np.rint((table[:, :3] - low) / self.scale)
        record["i"], record["rgb"] = table[:, 3], table[:, 4:]
        head = bytearray(HEADER_BYTES)
        head[:4] = b"LASF"
        struct.pack_into("<BB", head, 24, 1, 2)
        struct.pack_into("<HI", head, 94, HEADER_BYTES, HEADER_BYTES)
        struct.pack_into("<BHI", head, 104, 2, RECORD_BYTES[2], len(table))
        struct.pack_into("<6d", head, 131, *[self.scale] * 3, *low)
        struct.pack_into("<6d", head, 179, high[0], low[0], high[1], low[1], high[2], low[2])
        with open(f"{path}.tmp", "wb") as f:
            f.write(bytes(head) + record.tobytes())
        os.replace(f"{path}.tmp", path)
        return Written(path, len(table))

    def commit(self, messages: list[Written]) -> None:
        pass

    def abort(self, messages: list[Written]) -> None:
        for m in messages:
            if m and os.path.exists(m.path):
                os.remove(m.path)


class LasSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> LasReader:
        return LasReader(self.options)

    def writer(self, schema: object, overwrite: bool) -> LasWriter:
        return LasWriter(self.options)
