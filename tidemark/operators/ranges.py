"""Micro-batch ranges: predicate, read, and disjoint sub-ranges for parallel reads."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.offset_column import STRING, OffsetColumn


@dataclass(frozen=True)
class BatchRange:
    """The rows of one micro-batch: ``[start, end]`` if inclusive, else ``(start, end]``."""

    start: str
    end: str
    inclusive: bool = False

    def __post_init__(self) -> None:
        if self.start is None or self.end is None:
            raise ValueError(f"A batch range needs both bounds, got {self.start!r}, {self.end!r}.")


def start_predicate(offset: OffsetColumn, start: str, inclusive: bool) -> Column:
    bound = offset.literal(start)
    return offset.column() >= bound if inclusive else offset.column() > bound


def end_predicate(offset: OffsetColumn, end: str) -> Column:
    return offset.column() <= offset.literal(end)


def range_predicate(offset: OffsetColumn, batch: BatchRange) -> Column:
    """The whole condition. NULL offsets satisfy neither side, so they are never delivered."""
    return start_predicate(offset, batch.start, batch.inclusive) & end_predicate(offset, batch.end)


def read_range(df: DataFrame, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
    """The rows of ``batch``, still an ordinary DataFrame: pushdown and pruning stay open."""
    return df.where(range_predicate(offset, batch))


def read_nothing(df: DataFrame) -> DataFrame:
    """No rows, the schema of ``df``; Catalyst folds it to an empty relation without a scan."""
    return df.where(F.lit(False))


def split_range(offset: OffsetColumn, batch: BatchRange, parts: int) -> list[BatchRange]:
    """``batch`` as at most ``parts`` disjoint ranges that together cover it exactly.

    Strings have no arithmetic and stay whole. Cuts are equally wide, so a hot
    offset value lands in one part; split such tables on another column.
    """
    if parts <= 1 or offset.kind == STRING:
        return [batch]
    low, high = offset.to_point(batch.start), offset.to_point(batch.end)
    if low >= high:
        return [batch]
    cuts: list[str] = []
    last = low
    for i in range(1, parts):
        cut = _point_between(low, high, i, parts)
        if last < cut < high:
            cuts.append(offset.from_point(cut))
            last = cut
    starts, ends = [batch.start, *cuts], [*cuts, batch.end]
    return [
        BatchRange(start, end, batch.inclusive and i == 0)
        for i, (start, end) in enumerate(zip(starts, ends))
    ]


def _point_between(low, high, i: int, parts: int):
    if isinstance(low, int):
        return low + (high - low) * i // parts
    if isinstance(low, Decimal):
        return low + (high - low) * i / parts
    return low + (high - low) * (i / parts)
