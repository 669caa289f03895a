"""Columns computed by Python on Arrow batches, one bounded batch at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .worker import kept


def with_arrow_columns(df: DataFrame, start: Callable[[], Callable], fields: list[tuple[str, T.DataType]],
                       without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` less the columns ``without``, plus ``fields`` computed from each batch.

    ``start`` runs once per worker and returns ``batch -> list of arrays``, one per
    field.  Rows and their other columns pass unchanged; there is no shuffle.  A
    column of ``df`` with the name of a field gives way to it in the result."""
    made = {n.lower() for n, _ in fields}
    keep = [f for f in df.schema.fields if f.name not in without and f.name.lower() not in made]
    names = [f.name for f in keep]
    schema = T.StructType(keep + [T.StructField(n, t) for n, t in fields])

    owner = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = kept(owner, start)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + compute(batch),
                                             names=names + [n for n, _ in fields])

    return df.mapInArrow(run, schema)


def texts_as_bytes(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, row by row (null: None)."""
    column = batch.column(name)
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    for value in column:
        yield value.as_py()
