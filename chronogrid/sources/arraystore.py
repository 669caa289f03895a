"""Chunked array files: export a grid as fixed-size compressed chunks and read
them back as rows, both as distributed Spark jobs.

Layout (zarr version-2 style, so other array tools can open it)::

    <store>/.zgroup, .zattrs, .zmetadata     small JSON documents
    <store>/<var>/.zarray, .zattrs           shape, chunks, dtype, compressor
    <store>/<var>/<t>.<y>.<x>                zstd-compressed C-order float64 chunk

Export: ``groupBy(chunk).applyInPandas`` - one task per chunk tile packs every
variable of the tile into dense arrays (edges padded with the fill value) and
writes one file per variable.  Import: a DataFrame of chunk keys is generated
from the metadata, spread over tasks, and ``mapInPandas`` reads and decodes
each tile into rows.  Files are reached through ``pyarrow.fs`` so the store may
live on any file system the executors can reach.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Compressor and its level, element type, fill value.
ZSTD_LEVEL = 9
DTYPE = "<f8"
FILL = float("nan")

MANIFEST_SCHEMA = "variable string, key string, path string, n_values long, nbytes long"


def _fs(path: str):
    from pyarrow import fs as pafs
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _zarray(shape, chunks) -> dict:
    return {"chunks": list(chunks), "compressor": {"id": "zstd", "level": ZSTD_LEVEL}, "dtype": DTYPE,
            "fill_value": "NaN", "filters": None, "order": "C", "shape": list(shape), "zarr_format": 2}


def consolidated_metadata(variables: DataFrame, chunks: dict | None = None) -> DataFrame:
    """One-row DataFrame holding the consolidated metadata document of
    ``variables(varname, dims ARRAY, shape ARRAY)``; chunk sizes default to
    the whole dimension.  Built with column functions (no driver JSON)."""
    chunks = chunks or {}
    ch_map = F.create_map(*[x for k, v in chunks.items() for x in (F.lit(k), F.lit(int(v)))]) if chunks else None
    ch = F.transform(F.arrays_zip("dims", "shape"),
                     lambda z: F.least(F.coalesce(F.element_at(ch_map, z["dims"]), z["shape"]), z["shape"])
                     if ch_map is not None else z["shape"])
    zattrs = F.to_json(F.struct(F.col("dims").alias("_ARRAY_DIMENSIONS")))
    zarray = F.to_json(F.struct(
        ch.alias("chunks"),
        F.struct(F.lit("zstd").alias("id"), F.lit(ZSTD_LEVEL).alias("level")).alias("compressor"),
        F.lit(DTYPE).alias("dtype"), F.lit("NaN").alias("fill_value"), F.lit(None).cast("string").alias("filters"),
        F.lit("C").alias("order"), F.col("shape").alias("shape"), F.lit(2).alias("zarr_format")),
        {"ignoreNullFields": "false"})
    kv = variables.select(F.explode(F.array(
        F.struct(F.concat("varname", F.lit("/.zattrs")).alias("k"), zattrs.alias("v")),
        F.struct(F.concat("varname", F.lit("/.zarray")).alias("k"), zarray.alias("v")))).alias("e")).select("e.*")
    item = F.concat(F.to_json(F.array("k")).substr(F.lit(2), F.length(F.to_json(F.array("k"))) - 2), F.lit(": "), F.col("v"))
    doc = kv.agg(F.concat(F.lit('{"metadata": {".zgroup": {"zarr_format": 2}, ".zattrs": {}, '),
                          F.array_join(F.sort_array(F.collect_list(item)), ", "),
                          F.lit('}, "zarr_consolidated_format": 1}')).alias("value"))
    return doc


def _write_bytes(path: str, data: bytes) -> None:
    """Write to a unique temporary name, then rename into place: a retried or
    speculative task attempt never leaves a partial chunk behind, and the
    final content is the same whichever attempt wins."""
    import uuid
    fs, p = _fs(path)
    parent = p.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    tmp = f"{parent}/.tmp-{uuid.uuid4().hex}"
    with fs.open_output_stream(tmp) as f:
        f.write(data)
    fs.move(tmp, p)


def _read_bytes(path: str) -> bytes | None:
    fs, p = _fs(path)
    try:
        with fs.open_input_stream(p) as f:
            return f.read()
    except FileNotFoundError:      # absent: the fill value; any other fault is an error
        return None


# --- SR09 array_store_export --------------------------------------------------
def export_array_store(grid: DataFrame, store: str, variables, shape: tuple[int, int, int],
                       chunks: tuple[int, int, int], dims=("time", "y", "x"),
                       idx_cols=("time_idx", "y", "x"), attrs: dict | None = None,
                       per_variable: bool | None = None) -> DataFrame:
    """Write ``grid(time_idx, y, x, vars...)`` as chunk files; returns the
    manifest ``(variable, key, path, n_values, nbytes)`` (lazy: run an action).

    Each group is one chunk tile - of one variable when ``per_variable``
    (default with several variables: the grid is unpivoted first so a group
    holds one array's values, bounded by the chunk shape, whatever the number
    of variables)."""
    variables = list(variables)
    inside = F.lit(True)
    for c, n in zip(idx_cols, shape):
        inside = inside & (F.col(c) >= 0) & (F.col(c) < n)
    at = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in idx_cols])
    # on a key that every chunk needs, so the check can't be pruned
    grid = grid.withColumn(idx_cols[0], F.when(inside, F.col(idx_cols[0])).otherwise(
        F.raise_error(F.concat(F.lit(f"position outside the shape {tuple(shape)}: "), at)).cast("int")))
    per_variable = len(variables) > 1 if per_variable is None else per_variable
    ct, cy, cx = chunks
    ti, yi, xi = idx_cols
    keyed = grid.select(F.col(ti).alias("_t"), F.col(yi).alias("_y"), F.col(xi).alias("_x"),
                        *[F.col(v).cast("double").alias(v) for v in variables]) \
        .withColumns({"_tc": F.floor(F.col("_t") / ct), "_yc": F.floor(F.col("_y") / cy),
                      "_xc": F.floor(F.col("_x") / cx)})
    if per_variable:
        keyed = keyed.select("_t", "_y", "_x", "_tc", "_yc", "_xc", F.explode(F.array(*[
            F.struct(F.lit(v).alias("_var"), F.col(v).alias("_val")) for v in variables])).alias("_s")) \
            .select("_t", "_y", "_x", "_tc", "_yc", "_xc", "_s._var", "_s._val")

    def write_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard
        tc, yc, xc = int(pdf["_tc"].iloc[0]), int(pdf["_yc"].iloc[0]), int(pdf["_xc"].iloc[0])
        it = pdf["_t"].to_numpy(np.int64) - tc * ct
        iy = pdf["_y"].to_numpy(np.int64) - yc * cy
        ix = pdf["_x"].to_numpy(np.int64) - xc * cx
        comp = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        key = f"{tc}.{yc}.{xc}"
        cols = [(pdf["_var"].iloc[0], "_val")] if per_variable else [(v, v) for v in variables]
        out = []
        for v, c in cols:
            arr = np.full((ct, cy, cx), FILL, dtype=DTYPE)
            arr[it, iy, ix] = pdf[c].to_numpy(np.float64, na_value=np.nan)
            data = comp.compress(np.ascontiguousarray(arr).tobytes())
            path = f"{store}/{v}/{key}"
            _write_bytes(path, data)
            out.append((v, key, path, int(np.count_nonzero(~np.isnan(arr))), len(data)))
        return pd.DataFrame(out, columns=["variable", "key", "path", "n_values", "nbytes"])

    _write_metadata(store, variables, shape, chunks, dims, attrs or {})
    group = ["_tc", "_yc", "_xc"] + (["_var"] if per_variable else [])
    return keyed.groupBy(*group).applyInPandas(write_chunk, MANIFEST_SCHEMA)


def _write_metadata(store: str, variables, shape, chunks, dims, attrs) -> None:
    write_metadata(store, [(variables, shape, chunks, dims)], attrs)


def write_metadata(store: str, arrays, attrs: dict) -> None:
    """Small JSON documents (group, per variable, consolidated last) of ``(variables, shape, chunks, dims)`` groups."""
    meta = {".zgroup": {"zarr_format": 2}, ".zattrs": {}}
    for variables, shape, chunks, dims in arrays:
        for v in variables:
            meta[f"{v}/.zarray"] = _zarray(shape, chunks)
            meta[f"{v}/.zattrs"] = {"_ARRAY_DIMENSIONS": list(dims), **attrs.get(v, {})}
    for k, doc in meta.items():
        _write_bytes(f"{store}/{k}", json.dumps(doc, indent=2).encode())
    _write_bytes(f"{store}/.zmetadata",
                 json.dumps({"metadata": meta, "zarr_consolidated_format": 1}, indent=2).encode())


# --- SR08 array_store_import --------------------------------------------------
def read_array_meta(store: str) -> dict:
    raw = _read_bytes(f"{store}/.zmetadata")
    if raw is None:
        raise FileNotFoundError(f"{store}/.zmetadata")
    return json.loads(raw)["metadata"]


class _Chunks:
    """How the chunks of one array are decoded, from its own metadata."""

    def __init__(self, doc: dict):
        self.shape, self.chunks = tuple(doc["shape"]), tuple(doc["chunks"])
        self.dtype, self.order = np.dtype(doc["dtype"]), doc.get("order", "C")
        fill = doc.get("fill_value")
        self.fill = None if fill is None else float(fill)          # "NaN" and infinities included
        self.codec = (doc.get("compressor") or {"id": None})["id"]
        if doc.get("filters") or self.codec not in (None, "zstd", "zlib", "gzip"):
            raise ValueError(f"cannot decode filters {doc.get('filters')} or compressor {self.codec}")

    def decode(self, raw: bytes | None) -> np.ndarray:
        """One chunk as doubles; the fill value, and an absent chunk, are NaN."""
        if raw is None:
            return np.full(self.chunks, np.nan)
        size = int(np.prod(self.chunks)) * self.dtype.itemsize
        if self.codec == "zstd":
            import zstandard
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
        elif self.codec:
            import zlib
            raw = zlib.decompress(raw, wbits=47)                    # zlib and gzip headers
        if len(raw) != size:
            raise ValueError(f"a chunk holds {len(raw)} bytes, {size} expected")
        stored = np.frombuffer(raw, self.dtype).reshape(self.chunks, order=self.order)
        values = stored.astype(np.float64)
        if self.fill is not None and not np.isnan(self.fill):
            values[stored == np.array(self.fill).astype(self.dtype)] = np.nan
        return values


#: Decoded bytes of the tiles of one import task.
TASK_BYTES = 128 * 1024 * 1024


def import_array_store(spark: SparkSession, store: str, variables=None,
                       idx_names=("time_idx", "y", "x"), keep_missing: bool = True,
                       rows_per_frame: int = 100_000) -> DataFrame:
    """Rows ``(time_idx, y, x, vars...)`` of a chunked store.

    Every variable is decoded by its own metadata: element type, fill value, order,
    compressor, shape and chunks.  Chunk keys are generated by Spark from the (small)
    metadata and spread over tasks by the bytes they decode to; each task reads and
    decodes its tiles.  Fill values and absent chunks become NULL; a chunk that can't
    be read or decoded fails the job.  Positions beyond the array shape (edge
    padding) are dropped.  Variables of different shapes or chunks are read as frames
    of their own and joined on the position."""
    meta = read_array_meta(store)
    if variables is None:
        variables = sorted(k.split("/")[0] for k in meta if k.endswith("/.zarray")
                           and len(meta[k]["shape"]) == 3)
    arrays = {v: _Chunks(meta[f"{v}/.zarray"]) for v in variables}
    alike: dict[tuple, list[str]] = {}
    for v in variables:
        alike.setdefault((arrays[v].shape, arrays[v].chunks), []).append(v)
    names = list(idx_names)
    frames = [_import_alike(spark, store, {v: arrays[v] for v in group}, names, keep_missing, rows_per_frame)
              for group in alike.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, names, "full")
    return out.select(*names, *variables)


def _import_alike(spark: SparkSession, store: str, arrays: dict[str, _Chunks], names: list[str], keep_missing: bool,
                  rows_per_frame: int) -> DataFrame:
    """Variables of one shape and chunking as one frame."""
    variables = list(arrays)
    shape, chunks = arrays[variables[0]].shape, arrays[variables[0]].chunks
    n = [-(-s // c) for s, c in zip(shape, chunks)]
    total = n[0] * n[1] * n[2]
    ct, cy, cx = chunks
    by_bytes = -(-total * ct * cy * cx * 8 * len(variables) // TASK_BYTES)
    keys = (spark.range(total, numPartitions=max(1, min(total, max(by_bytes, spark.sparkContext.defaultParallelism))))
            .select((F.col("id") / (n[1] * n[2])).cast("int").alias("tc"),
                    ((F.col("id") / n[2]).cast("long") % n[1]).cast("int").alias("yc"),
                    (F.col("id") % n[2]).cast("int").alias("xc")))
    schema = T.StructType([T.StructField(k, T.IntegerType()) for k in names] + [T.StructField(v, T.DoubleType()) for v in variables])

    # a tile is decoded once, then emitted in slices of whole time steps of
    # about ``rows_per_frame`` rows, so no frame holds the full tile
    steps_per_frame = max(1, rows_per_frame // (cy * cx))

    def read_tiles(batches):
        for pdf in batches:
            for tc, yc, xc in zip(pdf["tc"], pdf["yc"], pdf["xc"]):
                decoded = {v: a.decode(_read_bytes(f"{store}/{v}/{tc}.{yc}.{xc}")) for v, a in arrays.items()}
                y = np.arange(cy) + yc * cy
                x = np.arange(cx) + xc * cx
                for t0 in range(0, ct, steps_per_frame):
                    t = np.arange(t0, min(ct, t0 + steps_per_frame)) + tc * ct
                    tt, yy, xx = np.meshgrid(t, y, x, indexing="ij")
                    inside = (tt < shape[0]) & (yy < shape[1]) & (xx < shape[2])
                    if not inside.any():
                        continue
                    cols = {k: i[inside].astype(np.int32) for k, i in zip(names, (tt, yy, xx))}
                    for v in variables:
                        cols[v] = decoded[v][t0:t0 + len(t)][inside]
                    out = pd.DataFrame(cols)
                    if not keep_missing:
                        out = out[out[variables].notna().any(axis=1)]
                    for v in variables:
                        out[v] = out[v].astype("float64").where(out[v].notna(), None)
                    yield out

    return keys.mapInPandas(read_tiles, schema)
