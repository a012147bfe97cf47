"""Offsets as JSON: the text kept in checkpoints and in the offset log."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JSON shape and key names of a stored offset.
OFFSET_JSON_SCHEMA = (
    "struct<fieldsOffsets: struct<fieldName: string, range: struct<start: string, end: string>>>"
)


def offset_to_json(field: Column, start: Column, end: Column) -> Column:
    """Columns of an offset as its JSON text; absent bounds are left out."""
    span = F.struct(start.alias("start"), end.alias("end"))
    inner = F.struct(field.alias("fieldName"), span.alias("range"))
    return F.to_json(F.struct(inner.alias("fieldsOffsets")))


def offset_from_json(text: Column) -> Column:
    """JSON text as a struct ``(field, start_offset, end_offset)``."""
    parsed = F.from_json(text, OFFSET_JSON_SCHEMA)["fieldsOffsets"]
    return F.struct(
        parsed["fieldName"].alias("field"),
        parsed["range"]["start"].alias("start_offset"),
        parsed["range"]["end"].alias("end_offset"),
    )


def offset_dict(field: str, start: str | None = None, end: str | None = None) -> dict[str, Any]:
    """The same shape as a Python dict, as stream readers exchange it with Spark."""
    span = {k: v for k, v in (("start", start), ("end", end)) if v is not None}
    return {"fieldsOffsets": {"fieldName": field, "range": span}}


def offset_bounds(offset: dict[str, Any], field: str) -> tuple[str | None, str | None]:
    """``(start, end)`` of an offset dict; an offset of another column is an error."""
    inner = offset["fieldsOffsets"]
    if inner["fieldName"].lower() != field.lower():
        raise ValueError(
            f"The checkpoint tracks '{inner['fieldName']}', but the offset field is '{field}'."
        )
    return inner["range"].get("start"), inner["range"].get("end")
