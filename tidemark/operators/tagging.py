"""Rows with the number of the batch that their offset falls into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.offset_column import OffsetColumn


def batch_number(offset: OffsetColumn, ends: list[str], column: Column | None = None) -> Column:
    """The place of the first of ``ends`` (in their order) at or above the offset, from 0.

    A binary search over a constant array, in the column's own type and order; one beyond the last
    end counts as the last.
    """
    value = offset.column() if column is None else column
    bounds = F.array(*(offset.literal(end) for end in ends))
    halvings = max(1, (len(ends) - 1).bit_length())

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        beyond = F.get(bounds, middle) < value
        low = F.when((at["low"] < at["high"]) & beyond, middle + 1).otherwise(at["low"])
        high = F.when((at["low"] < at["high"]) & ~beyond, middle).otherwise(at["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(ends) - 1).alias("high"))
    return F.aggregate(F.array_repeat(F.lit(0), halvings), whole, halve, lambda at: at["low"])


def dealt_by_batch(df: DataFrame, offset: OffsetColumn, ends: list[str], name: str) -> DataFrame:
    """``df`` with its batch number in ``name``, dealt so that a batch is written as few files.

    One shuffle; a batch larger than a task should hold is spread over several.
    """
    return df.withColumn(name, batch_number(offset, ends)).hint("rebalance", F.col(name))
