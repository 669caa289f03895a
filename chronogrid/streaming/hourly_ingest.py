"""Stream arriving hourly files into a grid store (JB02 run incrementally).

``readStream`` over the hourly file directory (explicit schema) ->
``foreachBatch``: region write into the hourly store, then the days the batch touched.
What is known of a cell-day (a mask of its hours and their values) is kept beside the
daily store, a folder a day: a batch's own states are merged into those of its days, and
the hourly store isn't read again.  A write merges by position and a state by hour, so an
hour may arrive in several files or batches, and a batch replayed after a failure
produces the same stores.
The stream checkpoint lives under the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import parse_base_date
from ..functions import timeaxis as ta
from ..functions.values import mask_missing
from ..operators.daily import daily_sources, day_state, days_of_states, merge_states
from ..operators.grid import KEYS
from ..session import materialise, scratch_path
from ..sources.gridstore import GridStore


def _day_times(hourly: GridStore, block: int) -> tuple[str, str]:
    first = parse_base_date(hourly.axis_start) + _dt.timedelta(days=block)
    return first.strftime("%Y-%m-%d %H:%M:%S"), (first + _dt.timedelta(hours=23)).strftime("%Y-%m-%d %H:%M:%S")


class DayStates:
    """Cell-day states of a daily store: ``daystate/_block=<day>``."""

    def __init__(self, hourly: GridStore, daily: GridStore):
        self.hourly, self.daily, self.path = hourly, daily, f"{daily.path}/daystate"
        names = daily_sources(hourly.variables)
        self.schema = ", ".join(["y int", "x int", "seen int", *[f"`{v}` array<double>" for v in names], "_block int"])
        self.columns = ["y", "x", "seen", *names, "_block"]
        spark = hourly.spark
        # the folder is made where there is none yet
        spark.createDataFrame([], self.schema).write.mode("append").partitionBy("_block").parquet(self.path)

    def read(self) -> DataFrame:
        return self.hourly.spark.read.schema(self.schema).parquet(self.path)

    def kept(self) -> set[int]:
        """Days that have states (one row a day)."""
        return {r[0] for r in self.read().select("_block").distinct().collect()}

    def unknown(self, blocks: list[int]) -> list[int]:
        """Days without states that the hourly store already has rows of: written before the states were kept."""
        kept = self.kept()
        return [b for b in blocks if b not in kept and not self.hourly.read([], *_day_times(self.hourly, b)).isEmpty()]

    def update(self, batch: DataFrame, blocks: list[int], unknown: list[int]) -> DataFrame:
        """Merges the batch's states into those of its days; the days' daily values of the cells it touched."""
        start, step = self.hourly.axis_start, self.hourly.spec.step_seconds
        new = day_state(batch, start, step)
        old = self.read().where(F.col("_block").isin(blocks))
        for b in unknown:
            begin, end = _day_times(self.hourly, b)
            old = old.unionByName(day_state(self.hourly.read(daily_sources(self.hourly.variables), begin, end), start, step).select(self.columns))
        merged = materialise(merge_states(old, new), "day-states")
        (merged.select(self.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_block").parquet(self.path))
        touched = merged.join(new.select("_block", "y", "x"), ["_block", "y", "x"], "left_semi")
        return days_of_states(touched, start)


def start_hourly_ingest(spark: SparkSession, source_dir: str, schema: StructType, hourly: GridStore,
                        daily: GridStore | None = None, checkpoint: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    variables = [v for v in hourly.variables if v in schema.names]
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir).select(*KEYS, *variables)

    states = DayStates(hourly, daily) if daily is not None else None

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = materialise(mask_missing(batch, variables), "batch")      # read from the source once
        block = F.floor(ta.seconds_since("time", hourly.axis_start) / 86400).cast("int")
        blocks = sorted(r[0] for r in batch.select(block).distinct().collect())          # one row a day
        unknown = states.unknown(blocks) if states and blocks else []
        hourly.write_region(batch, stage=False)
        if states and blocks:
            days = states.update(batch, blocks, unknown)
            daily.write_region(days.select(*KEYS, *[v for v in daily.variables if v in days.columns]))

    w = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
