"""How a stream moves: the first span, the next one, and the rows a span stands for.

A span ``(start, end)`` is what one micro-batch covers. The first starts at the
given start offset or the table's minimum and includes it; each later one starts
at the previous end and excludes it.
"""

from __future__ import annotations

from typing import NamedTuple

from tidemark.functions.offset_column import STRING, OffsetColumn
from tidemark.operators.ranges import BatchRange


class Span(NamedTuple):
    start: str | None
    end: str | None


def first_span(given_start: str | None, least: str | None, most: str | None) -> Span | None:
    """The first span, or None while the table has nothing at or above the start."""
    if most is None:
        return None
    return Span(least if given_start is None else given_start, most)


def next_span(offset: OffsetColumn, current: Span, most: str | None) -> Span | None:
    """The span after ``current``, or None if the table's end has not moved up.

    ``most`` is the maximum of the rows from ``current.end`` on, so the end never goes
    back: a table that shrank offers nothing new, and rows that arrive at or below the
    end are not delivered any more. Strings are in the order of their source, which may
    not be Python's: there any other value has moved up.
    """
    if most is None or offset.parse(most) == offset.parse(current.end):
        return None
    if offset.kind != STRING and offset.parse(most) < offset.parse(current.end):
        return None
    return Span(current.end, most)


def batch_range(previous: Span | None, span: Span) -> BatchRange:
    """The rows of ``span`` when the stream already delivered up to ``previous``."""
    if previous is None:
        return BatchRange(span.start, span.end, inclusive=True)
    return BatchRange(previous.end, span.end)
