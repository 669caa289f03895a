"""Spark session and shared scratch locations."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Rows go to Python in batches of bounded size: texts can be very long.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}

# Settings every job relies on: UTC session (zone-free time arithmetic is still
# used throughout, but parsing goes through the session zone), AQE for runtime
# coalescing and skew splitting, zstd Parquet.
BASE_CONF = ARROW_CONF | {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(master: str | None = None, app: str = "chronogrid",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.driver") and not k.startswith("spark.executor"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared location).  A
    private folder is created only when it is unset and the session is local;
    on a cluster executors would each write their own disk, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="chronogrid-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    return f"{root}/chronogrid/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once its results are written elsewhere."""
    remove_path(spark, scratch_root(spark))


#: Spark drops the shuffle files of an execution when it ends, not when the driver next collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind; other executions of the session keep theirs."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared scratch folder and read it back.

    The table is written once by committed tasks, so later passes over it see the
    same rows whatever executors are lost in between."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object of a location (Spark has no public call to rename or list folders)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is no longer needed."""
    if "://" not in path:
        shutil.rmtree(path, ignore_errors=True)
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)   # Spark has no public call for this
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per context)."""
    sc = spark.sparkContext
    if getattr(sc, "_chronogrid_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="chronogrid-pkg-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "chronogrid.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(pkg):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._chronogrid_shipped = True


def prepare_workers(spark: SparkSession) -> None:
    """What operators that run Python need of a session they didn't make."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)


def tune_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * 1024 * 1024,
                   min_partitions: int | None = None, shuffle_fraction: float = 0.25,
                   max_partitions: int = 65536) -> int:
    """Size shuffles and file splits for an input of ``input_bytes``.

    Scan splits are ``partition_bytes``.  Shuffles carry far less than the
    input (column pruning, partial aggregation), assumed ``shuffle_fraction``
    of it: initial shuffle partitions = that volume / ``partition_bytes``,
    between the default parallelism and ``max_partitions`` (shuffle metadata
    grows with map x reduce blocks).  AQE then coalesces small partitions and
    splits skewed ones towards the same advisory size.  Returns the count."""
    floor = min_partitions or spark.sparkContext.defaultParallelism
    want = -(-int(input_bytes * shuffle_fraction) // partition_bytes)
    n = int(min(max_partitions, max(floor, want)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    return n


def input_size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (Hadoop content summary: one metadata call)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())
