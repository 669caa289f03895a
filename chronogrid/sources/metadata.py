"""Small-file sources: variable list, variable metadata, consolidated array metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catalog import METADATA_COLUMNS


# --- SR11 variable_list_scan --------------------------------------------------
def read_variable_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of the variables to keep: CSV with a header and column ``variable``."""
    return (spark.read.option("header", True).schema("variable string").csv(path)
            .select("variable").where(F.col("variable").isNotNull()))


# --- SR12 metadata_scan -------------------------------------------------------
def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated variable metadata (named .csv in the reference); the five
    used columns, with the ``units`` of ``time`` forced missing."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    cols = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in METADATA_COLUMNS]
    out = df.select(*cols)
    return out.withColumn("units", F.when(F.col("varname") == "time", F.lit(None).cast("string"))
                          .otherwise(F.col("units")))


# --- SR10 array_metadata_scan -------------------------------------------------
ZATTRS = T.StructType([T.StructField("_ARRAY_DIMENSIONS", T.ArrayType(T.StringType()))])


def read_time_positions(spark: SparkSession, path: str) -> DataFrame:
    """Position of ``time`` among each variable's dimensions, from a consolidated
    metadata document ``{"metadata": {"<var>/.zattrs": {"_ARRAY_DIMENSIONS": [...]}}}``.
    Variables without ``time`` are left out.  The document is read whole by one
    task (it is one small file); everything after that is column expressions."""
    doc = spark.read.text(path, wholetext=True)
    meta = doc.select(F.from_json("value", "struct<metadata: map<string, string>>").alias("d"))
    kv = meta.select(F.explode("d.metadata").alias("key", "val"))
    parts = kv.select(F.split("key", "/").alias("p"), "val").where(F.size("p") == 2)
    attrs = parts.where(F.col("p")[1] == ".zattrs").select(
        F.col("p")[0].alias("varname"), F.from_json("val", ZATTRS)["_ARRAY_DIMENSIONS"].alias("dims"))
    pos = F.array_position("dims", "time")
    return attrs.where(pos > 0).select("varname", (pos - 1).cast("int").alias("time_pos"))


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """``(varname, shape)`` from the ``.zarray`` entries of a consolidated document."""
    doc = spark.read.text(path, wholetext=True)
    kv = doc.select(F.explode(F.from_json("value", "struct<metadata: map<string, string>>")["metadata"])
                    .alias("key", "val"))
    parts = kv.select(F.split("key", "/").alias("p"), "val").where(F.size("p") == 2)
    return parts.where(F.col("p")[1] == ".zarray").select(
        F.col("p")[0].alias("varname"),
        F.from_json("val", "struct<shape: array<bigint>>")["shape"].alias("shape"))
