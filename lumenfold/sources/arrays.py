"""PLY clouds and NPZ arrays as Python data sources."""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: PLY's type names.
PLY_TYPES = {
    "char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8",
    "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8",
}


def files_of(path: str, ending: str) -> list[str]:
    return sorted(glob.glob(os.path.join(path, f"*{ending}"))) if os.path.isdir(path) else [path]


@dataclass
class OneFile(InputPartition):
    path: str


def ply_header(path: str) -> tuple[str, int, list[tuple[str, str]], int]:
    """(format, vertices, [(property, dtype)], header bytes)."""
    form, count, fields, inside, size = "", 0, [], False, 0
    with open(path, "rb") as f:
        for line in f:
            size += len(line)
            words = line.decode("ascii", "replace").split()
            if not words:
                continue
            if words[0] == "format":
                form = words[1]
            elif words[0] == "element":
                inside = words[1] == "vertex"
                count = int(words[2]) if inside else count
            elif words[0] == "property" and inside:
                if words[1] == "list":
                    raise ValueError("list properties of vertices are not supported")
                fields.append((words[2], PLY_TYPES[words[1]]))
            elif words[0] == "end_header":
                return form, count, fields, size
    raise ValueError(f"{path} has no PLY header")


def spark_type(kind: str) -> T.DataType:
    if kind[0] == "f":
        return T.FloatType() if kind == "f4" else T.DoubleType()
    return T.LongType() if kind == "u4" else T.IntegerType() if kind in ("i4", "u2") else T.ShortType()


class PlyReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType) -> None:
        self.path, self.schema = path, schema

    def partitions(self) -> list[OneFile]:
        return [OneFile(f) for f in files_of(self.path, ".ply")]

    def read(self, part: OneFile) -> Iterator[pa.RecordBatch]:
        form, count, fields, size = ply_header(part.path)
        if form == "ascii":
            with open(part.path, "rb") as f:
                f.seek(size)
                table = np.loadtxt(f, max_rows=count, ndmin=2)
            columns = {n: table[:, k] for k, (n, _) in enumerate(fields)}
        else:
            order = ">" if form == "binary_big_endian" else "<"
            table = np.fromfile(part.path, dtype=[(n, order + k) for n, k in fields], count=count, offset=size)
            columns = {n: table[n] for n, _ in fields}
        arrow = {T.FloatType(): pa.float32(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.ShortType(): pa.int16()}
        arrays = [pa.array(np.arange(count, dtype=np.int32))]
        arrays += [pa.array(np.ascontiguousarray(columns[f.name]).astype(arrow[f.dataType].to_pandas_dtype())) for f in self.schema.fields[1:]]
        yield pa.RecordBatch.from_arrays(arrays, self.schema.names)


class PlySource(DataSource):
    """Vertices with the properties that the first file's header names, and their row number ``pid``."""

    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> T.StructType:
        fields = ply_header(files_of(self.options["path"], ".ply")[0])[2]
        return T.StructType([T.StructField("pid", T.IntegerType()), *(T.StructField(n, spark_type(k)) for n, k in fields)])

    def reader(self, schema: T.StructType) -> PlyReader:
        return PlyReader(self.options["path"], schema)


class NpzReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.keys = options["keys"].split(",")

    def partitions(self) -> list[OneFile]:
        return [OneFile(f) for f in files_of(self.path, ".npz")]

    def read(self, part: OneFile) -> Iterator[tuple]:
        with np.load(part.path, allow_pickle=False) as found:
            arrays = [found[k].astype(np.float64) if k in found.files else None for k in self.keys]
        rows = max((len(a) for a in arrays if a is not None and a.ndim), default=0)
        stem = os.path.splitext(os.path.basename(part.path))[0]
        for r in range(rows):
            yield (stem, r, *([float(v) for v in np.ravel(a[r])] if a is not None and r < len(a) else None for a in arrays))


class NpzSource(DataSource):
    """Parallel arrays of the option ``keys``, a row each; a key that a file lacks is null."""

    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> str:
        return "stem string, row int, " + ", ".join(f"{k} array<double>" for k in self.options["keys"].split(","))

    def reader(self, schema: object) -> NpzReader:
        return NpzReader(self.options)
