"""Offset bounds: the smallest and largest offset a table holds right now."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.offset_column import OffsetColumn

START_OFFSET = "start_offset"
END_OFFSET = "end_offset"


def start_bound(df: DataFrame, offset: OffsetColumn, at_most: str | None = None) -> DataFrame:
    """One row: ``MIN(offset)``, of the rows at or below ``at_most`` if given."""
    if at_most is not None:
        df = df.where(offset.column() <= offset.literal(at_most))
    return df.agg(F.min(offset.orderable()).alias(START_OFFSET))


def end_bound(df: DataFrame, offset: OffsetColumn, at_least: str | None = None) -> DataFrame:
    """One row: ``MAX(offset)``, of the rows at or above ``at_least`` if given."""
    if at_least is not None:
        df = df.where(offset.column() >= offset.literal(at_least))
    return df.agg(F.max(offset.orderable()).alias(END_OFFSET))


def both_bounds(df: DataFrame, offset: OffsetColumn) -> DataFrame:
    """One row with MIN and MAX from a single pass, so they belong to the same table state."""
    c = offset.orderable()
    return df.agg(F.min(c).alias(START_OFFSET), F.max(c).alias(END_OFFSET))


def fetch_bound(bound: DataFrame, offset: OffsetColumn) -> tuple[str | None, ...]:
    """Run a one-row probe and return its cells as offset text (None: no such row)."""
    row = bound.select([offset.carrier(F.col(c)).alias(c) for c in bound.columns]).first()
    return tuple(offset.from_carrier(value) for value in row)
