"""Variable catalog operators: attributes, metadata overlay, accumulation classes.

Catalog rows: ``(varname, dims ARRAY<STRING>, attrs MAP<STRING,STRING>,
encoding MAP<STRING,STRING>)``.  All edits are map functions on the rows; the
catalog never leaves Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import size_checked_broadcast

# Attributes removed from every variable.
REMOVE_ATTRS = ("esri_pe_string", "proj4", "_CoordinateAxisType", "resolution")

# Bucket variables and their shared class name.
BUCKET_VARS = ("I_ACLWDNB", "I_ACLWUPB", "I_ACSWDNB", "I_ACSWDNT", "I_ACSWUPB")
BUCKET_CLASS = "accumulated since 1979-10-01 00:00:00 bucket"

# Columns of the metadata file; the one moved to the encoding.
METADATA_COLUMNS = ("varname", "long_name", "standard_name", "units", "coordinates")
ENCODING_KEYS = ("coordinates",)


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


# --- PF05 rename ----------------------------------------------------------------
def rename(df: DataFrame, rename_dims: dict | None = None, rename_vars: dict | None = None) -> DataFrame:
    """Rename dimensions that exist (others ignored) and variables (all must exist)."""
    dims = {k: v for k, v in (rename_dims or {}).items() if k in df.columns}
    missing = [k for k in (rename_vars or {}) if k not in df.columns]
    if missing:
        raise KeyError(f"cannot rename absent variables: {missing}")
    return df.withColumnsRenamed({**dims, **(rename_vars or {})})


def rename_in_catalog(cat: DataFrame, rename_dims: dict | None = None, rename_vars: dict | None = None) -> DataFrame:
    """Same renames applied to catalog names and dimension lists."""
    m = F.create_map(*[F.lit(x) for kv in (rename_dims or {}).items() for x in kv]) if rename_dims else None
    dims = F.transform("dims", lambda d: F.coalesce(F.element_at(m, d), d)) if m is not None else F.col("dims")
    name = F.col("varname")
    for a, b in (rename_vars or {}).items():
        name = F.when(name == a, F.lit(b)).otherwise(name)
    return cat.withColumn("varname", name).withColumn("dims", dims)


# --- PF08 drop_attrs ------------------------------------------------------------
def drop_attrs(cat: DataFrame, names=REMOVE_ATTRS) -> DataFrame:
    drop = _lit_array(list(names))
    return cat.withColumn("attrs", F.map_filter("attrs", lambda k, v: ~F.array_contains(drop, k)))


# --- PF09 set_attrs -------------------------------------------------------------
def set_attrs(cat: DataFrame, new_attrs: dict[str, dict[str, str]]) -> DataFrame:
    """Set fixed attributes per variable (new keys win over existing ones)."""
    if not new_attrs:
        return cat
    per_var = F.create_map(*[x for var, attrs in new_attrs.items() for x in (
        F.lit(var), F.create_map(*[F.lit(s) for kv in attrs.items() for s in kv]))])
    new = F.coalesce(F.element_at(per_var, F.col("varname")), F.create_map().cast("map<string,string>"))
    return cat.withColumn("attrs", overwrite_map(F.col("attrs"), new))


def overwrite_map(old: Column, new: Column) -> Column:
    """``old`` updated by ``new``: ``map_concat`` raises on duplicate keys by
    default, so the overwritten keys are removed from ``old`` first."""
    kept = F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")),
                        lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)


# --- JN03 metadata_join / PF10 overlay_metadata -------------------------------
def metadata_map(meta: DataFrame) -> DataFrame:
    """Metadata table -> ``(varname, meta MAP)`` of its non-missing values."""
    cols = [c for c in METADATA_COLUMNS if c != "varname" and c in meta.columns]
    m = F.map_filter(F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))]),
                     lambda k, v: v.isNotNull())
    return meta.select("varname", m.alias("meta"))


def join_metadata(cat: DataFrame, meta: DataFrame) -> DataFrame:
    """JN03: catalog rows with their metadata row, if any.  The metadata side
    (one row per variable) is broadcast after a size check."""
    return cat.join(size_checked_broadcast(metadata_map(meta), 1024), "varname", "left")


def overlay_metadata(cat: DataFrame, meta: DataFrame) -> DataFrame:
    """PF10: non-missing metadata values overwrite attributes; ``coordinates``
    goes to the encoding instead."""
    enc_keys = _lit_array(list(ENCODING_KEYS))
    j = join_metadata(cat, meta)
    m = F.coalesce(F.col("meta"), F.create_map().cast("map<string,string>"))
    to_attrs = F.map_filter(m, lambda k, v: ~F.array_contains(enc_keys, k))
    to_enc = F.map_filter(m, lambda k, v: F.array_contains(enc_keys, k))
    return (j.withColumn("attrs", overwrite_map(F.col("attrs"), to_attrs))
            .withColumn("encoding", overwrite_map(F.col("encoding"), to_enc))
            .drop("meta"))


# --- PF11 classify_vars ---------------------------------------------------------
def classify(cat: DataFrame) -> DataFrame:
    """Accumulation class of each variable.

    ``integration_length`` attribute -> its value, except the bucket variables
    which share one class; no such attribute -> ``instantaneous`` when the
    variable has a time dimension, else ``constant``."""
    il = F.col("attrs").getItem("integration_length")
    cls = (F.when(il.isNotNull() & F.col("varname").isin(*BUCKET_VARS), F.lit(BUCKET_CLASS))
           .when(il.isNotNull(), il)
           .when(F.array_contains("dims", "time"), F.lit("instantaneous"))
           .otherwise(F.lit("constant")))
    return cat.withColumn("class", cls)


# --- PF12 split_constants -------------------------------------------------------
def constants(cat: DataFrame) -> DataFrame:
    return classify(cat).where(F.col("class") == "constant")


def time_varying(cat: DataFrame) -> DataFrame:
    return classify(cat).where(F.col("class") != "constant")


# --- AG12 group_vars ------------------------------------------------------------
def group_by_class(cat: DataFrame) -> DataFrame:
    """Variables per class, sorted.  The class named by a bucket variable's own
    ``integration_length`` exists even when it ends up empty."""
    c = classify(cat)
    filled = c.groupBy("class").agg(F.sort_array(F.collect_list("varname")).alias("variables"))
    implied = (c.where(F.col("varname").isin(*BUCKET_VARS) & F.col("attrs")["integration_length"].isNotNull())
               .select(F.col("attrs")["integration_length"].alias("class")).distinct())
    empty = implied.join(filled, "class", "left_anti").select(
        "class", F.array().cast("array<string>").alias("variables"))
    return filled.unionByName(empty)


# --- SL01 sort_vars -------------------------------------------------------------
def sorted_names(cat: DataFrame, cls: str = "instantaneous") -> DataFrame:
    return classify(cat).where(F.col("class") == cls).select("varname").orderBy("varname")


def attrs_long(cat: DataFrame, col: str = "attrs") -> DataFrame:
    """One row per (variable, key, value) of a map column."""
    return cat.select("varname", F.explode(col).alias("key", "value"))


# --- catalog attributes as column metadata -----------------------------------
def attrs_of(cat: DataFrame, columns) -> dict[str, dict[str, str]]:
    """Attributes of the named variables (one small row per column, so the
    catalog rows for a frame's columns are brought to the driver: they become
    part of its schema)."""
    rows = cat.where(F.col("varname").isin(*list(columns))).select("varname", "attrs").collect()
    return {r["varname"]: dict(r["attrs"] or {}) for r in rows}


def with_attrs(df: DataFrame, attrs: dict[str, dict[str, str]]) -> DataFrame:
    """Attach attributes as column metadata.  Metadata survives filters and a
    Parquet round trip but not aggregation, so it is re-attached after it."""
    for c, a in attrs.items():
        if c in df.columns:
            df = df.withMetadata(c, {**a})
    return df
