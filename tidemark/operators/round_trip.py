"""Do offsets survive their trip through text? Every value of a column, in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.plans.shipping import map_arrow


def round_trips(distinct: DataFrame, offset: OffsetColumn) -> DataFrame:
    """``parsed``: those of ``value`` (distinct offsets) that come back as they were.

    A value is carried to a task as a probe carries it to the driver, written as text, parsed and written again.
    It comes back if both texts are the same, what was parsed equals it, and so does the text as a literal.
    """
    kind = distinct.schema["value"].dataType
    schema = T.StructType([T.StructField("value", kind), T.StructField("parsed", kind), T.StructField("text", T.StringType())])
    carried = distinct.select("value", offset.carrier(F.col("value")).alias("carried"))
    made = map_arrow(carried, _Trips(offset), schema)
    value = F.col("value")
    return made.where((F.col("parsed") == value) & (F.col("text").cast(offset.data_type) == value)).select("parsed")


class _Trips:
    """Batches (value, carried) to (value, parsed, text)."""

    def __init__(self, offset: OffsetColumn) -> None:
        self._offset = offset

    def _trip(self, carried):
        offset = self._offset
        try:
            text = offset.from_carrier(carried)
            parsed = offset.parse(text)
            return (parsed, text) if offset.format(parsed) == text else (None, None)
        except (ArithmeticError, TypeError, ValueError):
            return None, None

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, carried = batch.columns
            parsed, text = zip(*map(self._trip, carried.to_pylist())) if len(value) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [value, _fitting(parsed, value.type), pa.array(text, pa.string())], ["value", "parsed", "text"]
            )


def _fitting(values: tuple, data_type: pa.DataType) -> pa.Array:
    """What does not fit the type is NULL."""
    out = []
    for v in values:
        try:
            out.append(pa.scalar(v, data_type))
        except (pa.ArrowException, OverflowError):
            out.append(pa.scalar(None, data_type))
    return pa.array(out, data_type)
