"""Hourly-store jobs (JB01, JB02, JB05 hourly, JB06, JB07, JB12)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GridSpec
from ..functions import timeaxis as ta
from ..functions import values as fv
from ..operators import catalog as cat
from ..operators.grid import CELL_KEYS, KEYS
from ..operators.joins import size_checked_broadcast
from ..sources import hourly_files, manifest
from ..sources.gridstore import GridStore


def chunk_index_of_texts(df: DataFrame, text_col: str, spec: GridSpec, formats=ta.HOURLY_FORMATS) -> DataFrame:
    """JB06: parse a column of date texts and add the chunk each falls in.

    A text no format accepts fails the job (the reference raises)."""
    t = ta.parse_datetime(text_col, formats)
    out = ta.require_parsed(df.withColumn("_t", t), text_col, "_t")
    return (out.withColumn("chunk", ta.chunk_index("_t", spec))
            .withColumn("label", ta.format_datetime("_t", "yyyy-MM-dd'T'HH")).drop("_t"))


def create_hourly(spark, path: str, first_chunk: DataFrame, spec: GridSpec, end_date,
                  catalog: DataFrame | None = None, cells: DataFrame | None = None):
    """JB01: empty hourly store whose axis runs from the first chunk's first
    time to ``end_date``; variables are the time-varying columns of the chunk."""
    first = first_chunk.agg(F.min("time")).collect()[0][0]           # one scalar
    variables = [c for c in first_chunk.columns if c not in KEYS]
    return GridStore.create(spark, path, spec, first, end_date, variables, catalog, cells)


def process_hourly(store, hourly: DataFrame, first_chunk: int | None = None, last_chunk: int | None = None,
                   catalog_overlay=None) -> None:
    """JB02 / JB12: insert hourly rows chunk-aligned into the store.

    All requested chunks go in one Spark job (no driver loop over chunks); the
    region write keeps untouched chunks and is idempotent on re-runs."""
    spec = store.spec
    df = hourly
    if first_chunk is not None or last_chunk is not None:
        c = ta.chunk_index("time", spec)
        lo = first_chunk if first_chunk is not None else -(2 ** 31)
        hi = last_chunk if last_chunk is not None else 2 ** 31 - 1
        df = df.where(c.between(lo, hi))
    store.write_region(df)


@dataclass(frozen=True)
class HourlyInput:
    """What the jobs take from hourly files: names in the files -> names in the store, and the catalog."""

    variables: dict[str, str]
    constants: dict[str, str]
    catalog: DataFrame
    file_catalog: DataFrame

    def decoded(self, df: DataFrame, names: dict[str, str], keys) -> DataFrame:
        """Columns of the files unpacked by their catalog and under their store names."""
        return cat.rename(fv.decode_packed(df, self.file_catalog).select(*keys, *names),
                          rename_vars={a: b for a, b in names.items() if a != b})


def describe_files(file_catalog: DataFrame, variable_list: DataFrame | None = None, rename_vars: dict | None = None,
                   metadata: DataFrame | None = None) -> HourlyInput:
    """The files' catalog, cut to the variable list (SR11), split by class (PF11, PF12),
    renamed (PF05), with attributes dropped (PF08) and metadata laid over (PF10).

    Scalars such as ``crs`` stay in the catalog only.  One row a variable is read on
    the driver."""
    kept = file_catalog
    if variable_list is not None:
        names = variable_list.select(F.col("variable").alias("varname")).distinct()
        kept = kept.join(size_checked_broadcast(names, 64), "varname", "left_semi")
    renames = rename_vars or {}
    rows = cat.classify(kept).select("varname", "class", F.size("dims").alias("n_dims")).collect()
    if missing := set(renames) - {r["varname"] for r in rows}:
        raise KeyError(f"cannot rename absent variables: {sorted(missing)}")
    named = lambda chosen: {r["varname"]: renames.get(r["varname"], r["varname"]) for r in sorted(chosen, key=lambda r: r["varname"])}
    constants = [r for r in rows if r["class"] == "constant" and r["n_dims"]]
    varying = [r for r in rows if r["class"] != "constant"]
    catalog = cat.rename_in_catalog(cat.drop_attrs(kept), rename_vars=renames)
    if metadata is not None:
        catalog = cat.overlay_metadata(catalog, metadata)
    # the store holds unpacked doubles
    catalog = catalog.withColumn("encoding", F.map_filter("encoding", lambda k, v: ~k.isin(*fv.PACKING_KEYS)))
    return HourlyInput(named(varying), named(constants), catalog.select("varname", "dims", "attrs", "encoding"), kept)


def _manifest(spark, spec: GridSpec, first_chunk: int, last_chunk: int, wrf_dir: str, template: str, listing) -> DataFrame:
    chunks = spark.range(first_chunk, last_chunk + 1).select(F.col("id").cast("int").alias("chunk"))
    m = manifest.hourly_manifest(chunks, spec, wrf_dir, template)
    return m if listing is None else manifest.verified_manifest(m, listing, wrf_dir, template)


def process_hourly_files(spark, store, first_chunk: int, last_chunk: int, wrf_dir: str, template: str,
                         files: HourlyInput, listing: DataFrame | None = None) -> None:
    """JB02 / JB12 from files: manifest of chunks ``first..last`` -> files that
    exist (Oct-1 rule) -> one scan, unpacked and renamed -> region write.  One Spark
    job per stage for the whole chunk range; no driver loop over chunks.

    The catalog gets the description's rows for the store's variables.  Constants
    belong to creation; the files' copies of them aren't read."""
    m = _manifest(spark, store.spec, first_chunk, last_chunk, wrf_dir, template, listing)
    names = {a: b for a, b in files.variables.items() if b in store.variables}
    grid, _ = hourly_files.scan_manifest(spark, m, store.spec, first_chunk, last_chunk, wrf_dir, template, list(names))
    described = files.catalog.where(F.col("varname").isin(*names.values()))
    store.write_catalog(store.catalog().join(described.select("varname"), "varname", "left_anti").unionByName(described))
    store.write_region(files.decoded(grid, names, KEYS))


def create_hourly_from_files(spark, path: str, spec: GridSpec, chunk: int, end_date, wrf_dir: str, template: str,
                             files: HourlyInput, listing: DataFrame | None = None):
    """JB01: the first chunk's files define the start of the axis and the constants;
    the store is created empty up to ``end_date`` with the whole catalog."""
    m = _manifest(spark, spec, chunk, chunk, wrf_dir, template, listing)
    grid, cells = hourly_files.scan_manifest(spark, m, spec, chunk, chunk, wrf_dir, template, list(files.variables), list(files.constants))
    first = grid.agg(F.min("time")).collect()[0][0]                    # one scalar
    if first is None:
        raise ValueError(f"no hourly files of chunk {chunk} under {wrf_dir}")
    return GridStore.create(spark, path, spec, first, end_date, list(files.variables.values()), files.catalog,
                            files.decoded(cells, files.constants, CELL_KEYS) if files.constants else None)
