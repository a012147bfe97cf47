"""The offset column: which types can track a stream, and how their values travel.

An offset is stored as text (in checkpoints and logs) but always compared typed.
``OffsetColumn`` holds the three conversions: text to Python value, Python value
to text, and text to a Spark literal of the column's own type.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = "number"
DATE = "date"
TIMESTAMP = "timestamp"
TIMESTAMP_NTZ = "timestamp_ntz"
STRING = "string"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)

# Fixed value: Spark's name for the order of bytes.
_BINARY = "UTF8_BINARY"

_EPOCH = datetime(1970, 1, 1)
_MICROSECOND = timedelta(microseconds=1)

# Date pattern letters of Spark's datetime patterns and their strptime form.
_PATTERN_TOKENS = {
    "yyyy": "%Y",
    "MM": "%m",
    "dd": "%d",
    "HH": "%H",
    "mm": "%M",
    "ss": "%S",
    "SSS": "%f",
    "SSSSSS": "%f",
}


def offset_kind(data_type: T.DataType) -> str:
    """The offset family of a Spark type; types without a total order are rejected."""
    if isinstance(data_type, _INTEGRAL + _FRACTIONAL):
        return NUMBER
    if isinstance(data_type, T.DateType):
        return DATE
    if isinstance(data_type, T.TimestampType):
        return TIMESTAMP
    if isinstance(data_type, T.TimestampNTZType):
        return TIMESTAMP_NTZ
    if isinstance(data_type, _TEXT):
        return STRING
    raise ValueError(f"A column of type '{data_type.simpleString()}' cannot be an offset.")


def find_field(schema: T.StructType, name: str) -> T.StructField:
    """The field called ``name``, ignoring case."""
    found = [f for f in schema.fields if f.name.lower() == name.lower()]
    if not found:
        raise ValueError(f"Offset field '{name}' is not in the schema: {schema.names}.")
    if len(found) > 1:
        raise ValueError(f"Offset field '{name}' is ambiguous in the schema: {schema.names}.")
    return found[0]


def _strptime_pattern(pattern: str) -> str | None:
    """A Spark date pattern as strptime, or None if a letter has no counterpart."""
    out, i = [], 0
    while i < len(pattern):
        letter = pattern[i]
        end = i
        while end < len(pattern) and pattern[end] == letter:
            end += 1
        run = pattern[i:end]
        if letter.isalpha():
            if run not in _PATTERN_TOKENS:
                return None
            out.append(_PATTERN_TOKENS[run])
        elif letter != "'":
            out.append(run.replace("%", "%%"))
        i = end
    return "".join(out)


@dataclass(frozen=True)
class OffsetColumn:
    """One increasing column of a table, the stream's only cursor."""

    name: str
    data_type: T.DataType
    kind: str
    time_zone: str = "UTC"

    @classmethod
    def of(cls, schema: T.StructType, name: str, time_zone: str = "UTC") -> OffsetColumn:
        field = find_field(schema, name)
        return cls(field.name, field.dataType, offset_kind(field.dataType), time_zone)

    @property
    def integral(self) -> bool:
        return isinstance(self.data_type, _INTEGRAL)

    @property
    def ordered_by_bytes(self) -> bool:
        """Whether Spark orders the column as its bytes do; collated strings it does not."""
        return getattr(self.data_type, "collation", _BINARY) == _BINARY

    def column(self) -> Column:
        return F.col("`" + self.name.replace("`", "``") + "`")

    # -- text -> value -----------------------------------------------------

    def parse(self, text: str) -> Any:
        """The value ``text`` stands for, as a Python object that orders like the column."""
        try:
            return self._parse(text)
        except (ValueError, InvalidOperation) as cause:
            raise ValueError(
                f"'{text}' is not a valid offset for '{self.name}' "
                f"({self.data_type.simpleString()})."
            ) from cause

    def _parse(self, text: str) -> Any:
        if self.kind == STRING:
            return text
        if self.kind == DATE:
            return datetime.fromisoformat(text.strip()).date()
        if self.kind == TIMESTAMP_NTZ:
            return datetime.fromisoformat(text.strip()).replace(tzinfo=None)
        if self.kind == TIMESTAMP:
            value = datetime.fromisoformat(text.strip())
            if value.tzinfo is None:
                value = value.replace(tzinfo=ZoneInfo(self.time_zone))
            return value.astimezone(timezone.utc)
        if self.integral:
            number = Decimal(text.strip())
            if number != int(number):
                raise ValueError("not a whole number")
            return int(number)
        if isinstance(self.data_type, T.DecimalType):
            return Decimal(text.strip())
        return _finite(float(text))

    def parse_option(self, text: str, pattern: str | None) -> str:
        """A user-given offset in canonical text; ``pattern`` is used when it is a valid one."""
        strptime = _strptime_pattern(pattern) if pattern else None
        if strptime is None or self.kind in (NUMBER, STRING):
            return self.format(self.parse(text))
        try:
            value = datetime.strptime(text.strip(), strptime)
        except ValueError as cause:
            raise ValueError(f"'{text}' does not follow the date format '{pattern}'.") from cause
        if self.kind == DATE:
            return value.date().isoformat()
        return self.format(self.parse(value.isoformat(sep=" ")))

    # -- value -> text -----------------------------------------------------

    def format(self, value: Any) -> str:
        """Canonical text; ``parse(format(v)) == v`` for every value of the column."""
        if self.kind == STRING:
            return value
        if self.kind == DATE:
            return value.isoformat()
        if self.kind == TIMESTAMP_NTZ:
            return value.isoformat(sep=" ")
        if self.kind == TIMESTAMP:
            return value.astimezone(timezone.utc).isoformat(sep=" ")
        if isinstance(value, Decimal):
            return format(value, "f")
        return str(value) if self.integral else repr(_finite(float(value)))

    # -- Spark side --------------------------------------------------------

    def literal(self, text: str) -> Column:
        """``text`` as a literal of the column's own type, so the filter can be pushed down."""
        return F.lit(self.format(self.parse(text))).cast(self.data_type)

    def orderable(self) -> Column:
        """The column as bounds see it: NaN orders after everything, so it counts as NULL."""
        if isinstance(self.data_type, (T.FloatType, T.DoubleType)):
            return F.nanvl(self.column(), F.lit(None).cast(self.data_type))
        return self.column()

    def carrier(self, column: Column) -> Column:
        """``column`` in a form the driver receives exactly, whatever its time zone."""
        return F.unix_micros(column) if self.kind == TIMESTAMP else column

    def from_carrier(self, value: Any) -> str | None:
        if value is None:
            return None
        if self.kind == TIMESTAMP:
            value = (_EPOCH + value * _MICROSECOND).replace(tzinfo=timezone.utc)
        return self.format(value)

    # -- number line, for cutting ranges ------------------------------------

    def to_point(self, text: str) -> int | float | Decimal:
        """The offset on a number line (days, microseconds or the number itself)."""
        value = self.parse(text)
        if self.kind == DATE:
            return value.toordinal()
        if self.kind in (TIMESTAMP, TIMESTAMP_NTZ):
            return (value.replace(tzinfo=None) - _EPOCH) // _MICROSECOND
        if self.kind == STRING:
            raise ValueError("Strings have no number line.")
        return value

    def from_point(self, point: int | float | Decimal) -> str:
        if self.kind == DATE:
            return self.format(date.fromordinal(point))
        if self.kind == TIMESTAMP_NTZ:
            return self.format(_EPOCH + point * _MICROSECOND)
        if self.kind == TIMESTAMP:
            return self.from_carrier(point)
        return self.format(point)


def _finite(value: float) -> float:
    if math.isnan(value):
        raise ValueError("NaN cannot be an offset: nothing orders after it.")
    return value
