"""Chunked array stores as a Spark data source: ``spark.read.format("chunkarray").load(path)``.

Reading plans its partitions from the store's metadata; comparisons of the index columns
with numbers narrow them to the chunks that can hold such rows, so other files aren't
opened.  Writing is committed in two phases: tasks write chunk files into a staging
folder, and only when all have ended are they moved into place and the metadata written;
an aborted write leaves what was there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage)

from ..session import ship_package
from . import arraystore
from .arraystore import DTYPE, TASK_BYTES, ZSTD_LEVEL, _Chunks, _fs, _read_bytes, _write_bytes, read_array_meta
from .blocks import three_dimensional

FORMAT = "chunkarray"
INDEX = ("time_idx", "y", "x")
#: Rows of a batch that a reader gives out.
BATCH_ROWS = 100_000


def register_source(spark: SparkSession) -> None:
    """Makes the format known to the session (once), filters included."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArraySource)


class ArraySource(DataSource):
    """Options: ``path``; for reading ``variables`` (comma-separated; default all of three
    dimensions, which must be chunked alike) and ``missing`` (``false``: only positions
    where some variable has a value); for writing ``shape`` and ``chunks`` (``t,y,x``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _variables(self, meta: dict) -> list[str]:
        given = self.options.get("variables")
        return [v.strip() for v in given.split(",")] if given else three_dimensional(meta)

    def schema(self) -> T.StructType:
        names = self._variables(read_array_meta(self.options["path"]))
        return T.StructType([T.StructField(c, T.IntegerType()) for c in INDEX] + [T.StructField(v, T.DoubleType()) for v in names])

    def reader(self, schema: T.StructType) -> ArrayReader:
        meta = read_array_meta(self.options["path"])
        return ArrayReader(self.options["path"], meta, [f.name for f in schema.fields if f.name not in INDEX], schema,
                           self.options.get("missing", "true").lower() != "false")

    def writer(self, schema: T.StructType, overwrite: bool) -> ArrayWriter:
        numbers = {k: tuple(int(n) for n in self.options[k].split(",")) for k in ("shape", "chunks")}
        return ArrayWriter(self.options["path"].rstrip("/"), [f.name for f in schema.fields if f.name not in INDEX], overwrite, **numbers)


class Run(InputPartition):
    """Chunks ``first .. end - 1`` among those that the filters leave, in order."""

    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class ArrayReader(DataSourceReader):
    def __init__(self, path: str, meta: dict, variables: list[str], schema: T.StructType, missing: bool):
        self.path, self.variables, self.missing = path, variables, missing
        self.columns = [f.name for f in schema.fields]
        self.arrays = {v: _Chunks(meta[f"{v}/.zarray"]) for v in variables}
        if len({(a.shape, a.chunks) for a in self.arrays.values()}) != 1:
            raise ValueError("variables of different shapes or chunks: read them apart")
        any_array = next(iter(self.arrays.values()))
        self.shape, self.chunks = any_array.shape, any_array.chunks
        self.low, self.high = [0, 0, 0], [n - 1 for n in self.shape]      # inclusive

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            yield f                          # Spark looks at the rows once more
            column = getattr(f, "attribute", None)
            if not column or len(column) != 1 or column[0] not in INDEX:
                continue
            k, value = INDEX.index(column[0]), getattr(f, "value", None)
            if isinstance(f, In):
                found = [v for v in value if isinstance(v, (int, float))]
                if len(found) == len(value) and found:
                    self._narrow(k, min(found), max(found))
            elif isinstance(value, (int, float)):
                if isinstance(f, EqualTo):
                    self._narrow(k, value, value)
                elif isinstance(f, GreaterThanOrEqual):
                    self._narrow(k, value, None)
                elif isinstance(f, LessThanOrEqual):
                    self._narrow(k, None, value)
                elif isinstance(f, GreaterThan):
                    self._narrow(k, np.floor(value) + 1, None)
                elif isinstance(f, LessThan):
                    self._narrow(k, None, np.ceil(value) - 1)

    def _narrow(self, k: int, low, high) -> None:
        if low is not None:
            self.low[k] = max(self.low[k], int(np.ceil(low)))
        if high is not None:
            self.high[k] = min(self.high[k], int(np.floor(high)))

    def _grid(self) -> tuple[list[int], list[int]]:
        """First chunk and number of chunks in every dimension."""
        first = [a // c for a, c in zip(self.low, self.chunks)]
        return first, [max(0, b // c - f + 1) if b >= a else 0 for a, b, c, f in zip(self.low, self.high, self.chunks, first)]

    def partitions(self) -> list[InputPartition]:
        _, n = self._grid()
        total = n[0] * n[1] * n[2]
        per_task = max(1, TASK_BYTES // (int(np.prod(self.chunks)) * 8 * len(self.variables)))
        return [Run(k, min(k + per_task, total)) for k in range(0, total, per_task)] or [Run(0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        first, n = self._grid()
        for number in range(partition.first, partition.end):
            key = [f + k for f, k in zip(first, (number // (n[1] * n[2]), number // n[2] % n[1], number % n[2]))]
            yield from self._chunk(key)

    def _chunk(self, key: list[int]) -> Iterator[pa.RecordBatch]:
        raw = {v: _read_bytes(f"{self.path}/{v}/{'.'.join(map(str, key))}") for v in self.variables}
        if not self.missing and not any(r is not None for r in raw.values()):
            return
        begin = [k * c for k, c in zip(key, self.chunks)]
        low = [max(a, b) for a, b in zip(self.low, begin)]
        high = [min(z, b + c - 1) for z, b, c in zip(self.high, begin, self.chunks)]
        inside = tuple(slice(a - b, z - b + 1) for a, z, b in zip(low, high, begin))
        values = {v: self.arrays[v].decode(r)[inside] for v, r in raw.items()}
        shape = [z - a + 1 for a, z in zip(low, high)]
        steps = max(1, BATCH_ROWS // (shape[1] * shape[2]))
        for t in range(0, shape[0], steps):
            some = {v: a[t:t + steps].reshape(-1) for v, a in values.items()}
            index = np.indices((min(steps, shape[0] - t), shape[1], shape[2]), np.int32).reshape(3, -1)
            columns = {c: index[k] + np.int32(low[k] + (t if k == 0 else 0)) for k, c in enumerate(INDEX)} | some
            if not self.missing:
                keep = np.any([~np.isnan(a) for a in some.values()], axis=0)
                columns = {c: a[keep] for c, a in columns.items()}
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], mask=np.isnan(columns[c]) if c in some else None) for c in self.columns],
                                             names=self.columns)


class Written(WriterCommitMessage):
    def __init__(self, keys: list[str]):
        self.keys = keys


class ArrayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, variables: list[str], overwrite: bool, shape: tuple, chunks: tuple):
        self.path, self.variables, self.overwrite, self.shape, self.chunks = path, variables, overwrite, shape, chunks
        self.staging = f"{path}/_staging-{uuid.uuid4().hex}"
        if not overwrite and _read_bytes(f"{path}/.zmetadata") is not None:
            raise ValueError(f"there is a store at {path}: write with mode overwrite")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import zstandard
        coder = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        closed: set[tuple] = set()
        tile, values, filled = None, None, None

        def close() -> None:
            closed.add(tile)
            for v, a in values.items():
                _write_bytes(f"{self.staging}/{v}/{'.'.join(map(str, tile))}", coder.compress(a.tobytes()))

        for batch in iterator:
            index = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in INDEX]).astype(np.int64)
            if index.size and ((index < 0) | (index >= np.array(self.shape)[:, None])).any():
                raise ValueError(f"a position lies outside the shape {self.shape}")
            of = index // np.array(self.chunks)[:, None]
            change = np.nonzero((of[:, 1:] != of[:, :-1]).any(axis=0))[0] + 1
            data = {v: batch.column(v).to_numpy(zero_copy_only=False).astype(DTYPE) for v in self.variables}
            for a, z in zip([0, *change], [*change, batch.num_rows]):
                if a == z:
                    continue
                here = tuple(of[:, a].tolist())
                if here != tile:
                    if tile is not None:
                        close()
                    if here in closed:
                        raise ValueError("the rows of a chunk must come together: see by_chunk")
                    tile = here
                    values = {v: np.full(self.chunks, np.nan, DTYPE) for v in self.variables}
                    filled = np.zeros(self.chunks, bool)
                at = tuple(index[:, a:z] - np.array(tile)[:, None] * np.array(self.chunks)[:, None])
                if filled[at].any() or len(set(zip(*(x.tolist() for x in at)))) < z - a:
                    raise ValueError(f"two rows at one position of chunk {tile}")
                filled[at] = True
                for v in self.variables:
                    values[v][at] = data[v][a:z]
        if tile is not None:
            close()
        return Written([".".join(map(str, t)) for t in closed])

    def commit(self, messages: list[Written | None]) -> None:
        keys = [k for m in messages if m is not None for k in m.keys]
        if len(keys) != len(set(keys)):
            self.abort(messages)
            raise ValueError("a chunk was written by two tasks: see by_chunk")
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:                    # from here to the metadata there is no store
            for old in (".zmetadata", ".zgroup", ".zattrs"):
                if fs.get_file_info(f"{root}/{old}").type.name == "File":
                    fs.delete_file(f"{root}/{old}")
            for info in fs.get_file_info(_selector(root)):
                if info.type.name == "Directory" and not info.base_name.startswith("_staging-"):
                    fs.delete_dir(info.path)
        staged = _fs(self.staging)[1]
        for v in self.variables:
            fs.create_dir(f"{root}/{v}", recursive=True)
            for k in keys:
                fs.move(f"{staged}/{v}/{k}", f"{root}/{v}/{k}")
        self._clear()
        arraystore.write_metadata(self.path, [(self.variables, self.shape, self.chunks, ("time", "y", "x"))], {})

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, p = _fs(self.staging)
        if fs.get_file_info(p).type.name == "Directory":
            fs.delete_dir(p)


def _selector(root: str):
    from pyarrow import fs as pafs
    return pafs.FileSelector(root)


def by_chunk(grid: DataFrame, chunks: tuple[int, int, int]) -> DataFrame:
    """``grid`` (index columns and variables) with the rows of a chunk together, as the writer needs them."""
    tile = [F.floor(F.col(c) / n).cast("int") for c, n in zip(INDEX, chunks)]
    return grid.repartition(*tile).sortWithinPartitions(*tile)


def write_array(grid: DataFrame, path: str, shape: tuple[int, int, int], chunks: tuple[int, int, int], mode: str = "error") -> None:
    """SR09 through the data source: ``grid(time_idx, y, x, variables...)`` as an array store, committed as a whole."""
    register_source(grid.sparkSession)
    rows = grid.select(*[F.col(c).cast("int").alias(c) for c in INDEX], *[F.col(c).cast("double").alias(c) for c in grid.columns if c not in INDEX])
    writer = by_chunk(rows, chunks).write.format(FORMAT).option("shape", ",".join(map(str, shape))).option("chunks", ",".join(map(str, chunks)))
    writer.mode("overwrite" if mode == "overwrite" else "append").save(path)


def read_array(spark: SparkSession, path: str, variables=None, missing: bool = True) -> DataFrame:
    """SR08 through the data source."""
    register_source(spark)
    reader = spark.read.format(FORMAT).option("missing", str(missing).lower())
    return (reader.option("variables", ",".join(variables)) if variables else reader).load(path)
