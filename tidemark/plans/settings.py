"""The options of an incremental read, checked against the table's schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

from tidemark.functions.offset_column import TIMESTAMP, OffsetColumn

# Option keys.
OFFSET_FIELD = "offset.field"
OFFSET_FIELD_DATE_FORMAT = "offset.field.date.format"
START_OFFSET = "start.offset"
TIME_ZONE = "timeZone"

OWN_KEYS = frozenset({OFFSET_FIELD, OFFSET_FIELD_DATE_FORMAT, START_OFFSET})
_OWN_PREFIXES = ("offset.", "start.")


@dataclass(frozen=True)
class Settings:
    """What to track and where to start."""

    offset: OffsetColumn
    start: str | None = None

    @classmethod
    def of(cls, options: Mapping[str, str], schema: T.StructType | None) -> Settings:
        if schema is None:
            raise ValueError("The schema is missing.")
        given = {key.lower(): value for key, value in options.items()}
        unknown = sorted(k for k in given if k.startswith(_OWN_PREFIXES) and k not in OWN_KEYS)
        if unknown:
            raise ValueError(f"Unknown options {unknown}; known are {sorted(OWN_KEYS)}.")
        if not given.get(OFFSET_FIELD):
            raise ValueError(f"Option '{OFFSET_FIELD}' is missing.")
        zone = given.get(TIME_ZONE.lower())
        offset = OffsetColumn.of(schema, given[OFFSET_FIELD], zone or "UTC")
        start, pattern = given.get(START_OFFSET), given.get(OFFSET_FIELD_DATE_FORMAT)
        if start is not None:
            if offset.kind == TIMESTAMP and zone is None and (pattern or _zoneless(start)):
                raise ValueError(
                    f"'{start}' means another instant in every time zone: give it with its offset "
                    f"from UTC, or set '{TIME_ZONE}'."
                )
            start = offset.parse_option(start, pattern)
        return cls(offset, start)


def _zoneless(text: str) -> bool:
    try:
        return datetime.fromisoformat(text.strip()).tzinfo is None
    except ValueError:  # reported when it is parsed
        return False


def source_options(options: Mapping[str, str]) -> dict[str, str]:
    """The options meant for the table's own reader: everything but ours."""
    return {k: v for k, v in options.items() if k.lower() not in OWN_KEYS}
