"""What may change in a table that is followed: columns that come, and types that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each type holds all values of those before it in its row.
_ROWS = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType),
    (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaChanged(ValueError):
    """The table has changed in a way that would lose values or columns."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    if old == new:
        return True
    if isinstance(new, T.DecimalType):
        whole = new.precision - new.scale
        if isinstance(old, T.DecimalType):
            return old.scale <= new.scale and old.precision - old.scale <= whole
        return _DIGITS.get(type(old), 99) <= whole
    return any(type(old) in row and type(new) in row and row.index(type(old)) <= row.index(type(new)) for row in _ROWS)


def check_evolution(old: T.StructType, new: T.StructType) -> None:
    """Raise unless ``new`` has every column of ``old``, each with a type that holds its values."""
    types = {f.name: f.dataType for f in new}
    lost = [f.name for f in old if f.name not in types]
    if lost:
        raise SchemaChanged(f"Columns {lost} are gone from the table.")
    narrower = [f"{f.name}: {f.dataType.simpleString()} to {types[f.name].simpleString()}" for f in old if not widens(f.dataType, types[f.name])]
    if narrower:
        raise SchemaChanged(f"Columns have types that do not hold what they held: {narrower}.")


def shape(schema: T.StructType) -> T.StructType:
    """Names and types alone, by which schemas are compared."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of an earlier ``schema`` of its table."""
    if shape(df.schema) == shape(schema):
        return df
    return df.select(*(F.col("`" + f.name.replace("`", "``") + "`").cast(f.dataType).alias(f.name) for f in schema))
