"""Rechunking of chunked arrays by blocks.

A chunk is one row: where it begins, its shape and its values packed as bytes.  Blocks
are cut at the borders of the target's chunks into sub-blocks, which one exchange brings
to their target chunk, where they are laid into place.  No value ever is a row of its
own: what is exchanged is the bytes of the array and about 60 bytes a sub-block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import arraystore
from .arraystore import DTYPE, TASK_BYTES, ZSTD_LEVEL, _Chunks, _read_bytes, _write_bytes, read_array_meta

PLACE = "t0 int, y0 int, x0 int, nt int, ny int, nx int"
BLOCK = f"variable string, {PLACE}, data binary"
PIECE = f"variable string, tt int, ty int, tx int, {PLACE}, data binary"
TILE = ("variable", "tt", "ty", "tx")
_INTS = ("t0", "y0", "x0", "nt", "ny", "nx")


def _batch(schema: list[str], row: tuple) -> pa.RecordBatch:
    """One row: a block is large."""
    kind = {"variable": pa.string(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([v], kind.get(n, pa.int32())) for n, v in zip(schema, row)], names=schema)


def _rows(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() if n != "data" else c[i].as_buffer() for n, c in zip(names, columns))


def three_dimensional(meta: dict) -> list[str]:
    return sorted(k.split("/")[0] for k in meta if k.endswith("/.zarray") and len(meta[k]["shape"]) == 3)


def read_blocks(spark: SparkSession, store: str, variables=None) -> DataFrame:
    """The chunks of an array store as blocks of doubles, cropped to the array's shape.

    Absent chunks give no block; fill values are NaN."""
    meta = read_array_meta(store)
    arrays = {v: _Chunks(meta[f"{v}/.zarray"]) for v in variables or three_dimensional(meta)}
    frames = []
    for v, a in arrays.items():
        n = [-(-s // c) for s, c in zip(a.shape, a.chunks)]
        total = n[0] * n[1] * n[2]
        tasks = max(min(total, spark.sparkContext.defaultParallelism), -(-total * int(np.prod(a.chunks)) * 8 // TASK_BYTES))
        frames.append(spark.range(total, numPartitions=max(1, min(total, tasks))).select("id", F.lit(v).alias("variable")))
    keys = frames[0]
    for f in frames[1:]:
        keys = keys.unionByName(f)
    names = ["variable", *_INTS, "data"]

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, v in _rows(batches, ["id", "variable"]):
            a = arrays[v]
            n = [-(-s // c) for s, c in zip(a.shape, a.chunks)]
            key = number // (n[1] * n[2]), number // n[2] % n[1], number % n[2]
            raw = _read_bytes(f"{store}/{v}/{'.'.join(map(str, key))}")
            if raw is None:
                continue
            begin = [k * c for k, c in zip(key, a.chunks)]
            size = [min(c, s - b) for c, s, b in zip(a.chunks, a.shape, begin)]
            values = a.decode(raw)[:size[0], :size[1], :size[2]]
            yield _batch(names, (v, *begin, *size, np.ascontiguousarray(values, DTYPE).tobytes()))

    return keys.mapInArrow(load, BLOCK)


def cut(blocks: DataFrame, chunks: tuple[int, int, int]) -> DataFrame:
    """Blocks cut at the borders of the target's chunks: one row a block and target chunk that meet."""
    names = ["variable", *_INTS, "data"]
    out = [*TILE, *_INTS, "data"]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v, t0, y0, x0, nt, ny, nx, data in _rows(batches, names):
            values = np.frombuffer(data, DTYPE).reshape(nt, ny, nx)
            begin, end = (t0, y0, x0), (t0 + nt, y0 + ny, x0 + nx)
            for tt in range(t0 // chunks[0], -(-end[0] // chunks[0])):
                for ty in range(y0 // chunks[1], -(-end[1] // chunks[1])):
                    for tx in range(x0 // chunks[2], -(-end[2] // chunks[2])):
                        low = [max(b, k * c) for b, k, c in zip(begin, (tt, ty, tx), chunks)]
                        high = [min(e, (k + 1) * c) for e, k, c in zip(end, (tt, ty, tx), chunks)]
                        part = values[tuple(slice(a - b, z - b) for a, z, b in zip(low, high, begin))]
                        yield _batch(out, (v, tt, ty, tx, *low, *part.shape, np.ascontiguousarray(part).tobytes()))

    return blocks.mapInArrow(split, PIECE)


def assemble(pieces: DataFrame, chunks: tuple[int, int, int], shape: tuple[int, int, int]) -> DataFrame:
    """Sub-blocks laid into the target's chunks (cropped to ``shape``); what no sub-block covers is NaN.

    The one exchange; a task holds one target chunk at a time.  Sub-blocks that overlap
    fail the job."""
    dealt = pieces.repartition(*TILE).sortWithinPartitions(*TILE)
    names = ["variable", *_INTS, "data"]

    def lay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, begin, values, laid = None, None, None, 0

        def done():
            if laid > values.size or laid > np.prod(values.shape):
                raise ValueError(f"sub-blocks overlap in chunk {tile}")
            return _batch(names, (tile[0], *begin, *values.shape, values.tobytes()))

        for row in _rows(batches, [*TILE, *_INTS, "data"]):
            if row[:4] != tile:
                if tile is not None:
                    yield done()
                tile, laid = row[:4], 0
                begin = [k * c for k, c in zip(tile[1:], chunks)]
                values = np.full([min(c, s - b) for c, s, b in zip(chunks, shape, begin)], np.nan, DTYPE)
            t0, y0, x0, nt, ny, nx, data = row[4:]
            values[t0 - begin[0]:t0 - begin[0] + nt, y0 - begin[1]:y0 - begin[1] + ny, x0 - begin[2]:x0 - begin[2] + nx] = \
                np.frombuffer(data, DTYPE).reshape(nt, ny, nx)
            laid += nt * ny * nx
        if tile is not None:
            yield done()

    return dealt.mapInArrow(lay, BLOCK)


def write_blocks(blocks: DataFrame, store: str, chunks: tuple[int, int, int]) -> DataFrame:
    """Blocks that are whole chunks, written as chunk files (padded at the array's edges); the manifest of what was written."""
    names = ["variable", *_INTS, "data"]

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        coder = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        for v, t0, y0, x0, nt, ny, nx, data in _rows(batches, names):
            values = np.frombuffer(data, DTYPE).reshape(nt, ny, nx)
            count = int(np.count_nonzero(~np.isnan(values)))
            if values.shape != tuple(chunks):
                values = np.pad(values, [(0, c - n) for c, n in zip(chunks, values.shape)], constant_values=np.nan)
            key = ".".join(str(b // c) for b, c in zip((t0, y0, x0), chunks))
            packed = coder.compress(np.ascontiguousarray(values).tobytes())
            _write_bytes(f"{store}/{v}/{key}", packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]), pa.array([key]), pa.array([f"{store}/{v}/{key}"]), pa.array([count], pa.int64()), pa.array([len(packed)], pa.int64())],
                names=["variable", "key", "path", "n_values", "nbytes"])

    return blocks.mapInArrow(save, arraystore.MANIFEST_SCHEMA)


def rechunk_array_store(spark: SparkSession, source: str, target: str, chunks: dict[str, int], variables=None) -> DataFrame:
    """LY01 / JB02: an array store written anew with other chunks; returns the manifest of its files.

    ``chunks`` maps dimensions to sizes: capped at the dimension's length, the whole
    length where a dimension isn't named.  The target's metadata is written last: until
    then there is no store at ``target``.  Variables of different shapes are dealt apart."""
    meta = read_array_meta(source)
    names = list(variables or three_dimensional(meta))
    groups: dict[tuple, list[str]] = {}
    for v in names:
        dims = tuple(meta[f"{v}/.zattrs"]["_ARRAY_DIMENSIONS"])
        groups.setdefault((dims, tuple(meta[f"{v}/.zarray"]["shape"])), []).append(v)
    made, documents = [], []
    for (dims, shape), group in groups.items():
        size = tuple(min(int(chunks.get(d, n)), n) for d, n in zip(dims, shape))
        made.append(write_blocks(assemble(cut(read_blocks(spark, source, group), size), size, shape), target, size))
        documents.append((group, shape, size, dims))
    manifest = made[0]
    for more in made[1:]:
        manifest = manifest.unionByName(more)
    manifest = materialise(manifest, "rechunked")
    attrs = {v: {k: x for k, x in meta[f"{v}/.zattrs"].items() if k != "_ARRAY_DIMENSIONS"} for v in names}
    arraystore.write_metadata(target, documents, attrs)
    return manifest
