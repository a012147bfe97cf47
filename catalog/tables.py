"""One offset column per family, and how its range is halved in Spark and in SQL."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.offset_column import STRING, OffsetColumn
from tidemark.operators.bounds import both_bounds, fetch_bound
from tidemark.operators.ranges import BatchRange, split_range
from tidemark.sources.tables import FrameTable, ParquetTable

#: Rows of a file of a copy that is dealt out for a query.
ROWS_A_FILE = 1_000_000


def n_files(n_rows: int, least: int) -> int:
    """How many files such a copy has: more for more rows, so that no task grows with the table."""
    return max(least, -(-n_rows // ROWS_A_FILE))


class Tracked(NamedTuple):
    """A table tracked by ``field``; ``derived`` adds the field where files lack it."""

    table: str
    field: str
    midpoint: str
    derived: str | None = None

    def frame(self, spark: SparkSession, sf: str) -> DataFrame:
        df = spark.read.parquet(f"{sf}/{self.table}.parquet")
        return df if self.derived is None else df.withColumn(self.field, F.expr(self.derived))

    def source(self, spark: SparkSession, sf: str) -> FrameTable:
        if self.derived is None:
            return ParquetTable(spark, f"{sf}/{self.table}.parquet")
        return FrameTable(lambda: self.frame(spark, sf))

    def offset(self, df: DataFrame) -> OffsetColumn:
        return OffsetColumn.of(df.schema, self.field)

    @property
    def sql_table(self) -> str:
        """The table as SQL, with the derived field."""
        if self.derived is None:
            return self.table
        return f"(SELECT *, {self.derived} AS {self.field} FROM {self.table}) t"

    @property
    def sql_bounds(self) -> str:
        """A CTE list that ends in ``m(lo, mid, hi)``."""
        bounds = f"MIN({self.field}) AS lo, MAX({self.field}) AS hi"
        return (
            f"b AS (SELECT {bounds} FROM {self.sql_table}), "
            f"m AS (SELECT lo, hi, {self.midpoint} AS mid FROM b)"
        )


TRACKED = {
    "number": Tracked("events", "event_id", "lo + (hi - lo) // 2"),
    "double": Tracked("part", "p_retailprice", "lo + (hi - lo) * 0.5"),
    "date": Tracked(
        "orders",
        "o_date",
        "lo + CAST(date_diff('day', lo, hi) // 2 AS INTEGER)",
        "CAST(o_orderdate AS DATE)",
    ),
    "string": Tracked(
        "customer",
        "c_name",
        "(SELECT MAX(c_name) FROM customer WHERE c_custkey <= "
        "(SELECT MIN(c_custkey) + (MAX(c_custkey) - MIN(c_custkey)) // 2 FROM customer))",
    ),
    "ts": Tracked("events", "ts", "lo + to_microseconds(date_diff('microsecond', lo, hi) // 2)"),
    "ties": Tracked("lineitem", "l_orderkey", "lo + (hi - lo) // 2"),
    "int": Tracked("lineitem", "l_line", "lo + (hi - lo) // 2", "CAST(l_linenumber AS INTEGER)"),
    "float": Tracked(
        "part",
        "p_price",
        "CAST(CAST(lo AS DOUBLE) + (CAST(hi AS DOUBLE) - CAST(lo AS DOUBLE)) * 0.5 AS FLOAT)",
        "CAST(p_retailprice AS FLOAT)",
    ),
    "decimal": Tracked(
        "orders",
        "o_amount",
        "CAST(lo + (hi - lo) * 0.5 AS DECIMAL(18,3))",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,3))",
    ),
}

#: Families that are tracked by a column the files lack, in addition to those of the given files.
DERIVED = ("int", "float", "decimal")


class Halves(NamedTuple):
    """A table with its offset range cut in two: ``[lo, mid]`` and ``(mid, hi]``."""

    df: DataFrame
    offset: OffsetColumn
    lower: BatchRange
    upper: BatchRange


def halves(spark: SparkSession, sf: str, kind: str) -> Halves:
    tracked = TRACKED[kind]
    df = tracked.frame(spark, sf)
    offset = tracked.offset(df)
    lo, hi = fetch_bound(both_bounds(df, offset), offset)
    if offset.kind != STRING:
        return Halves(df, offset, *split_range(offset, BatchRange(lo, hi, True), 2))
    # Strings have no midpoint: take the name that stands in the middle of the keys.
    key = OffsetColumn.of(df.schema, "c_custkey")
    keys = BatchRange(*fetch_bound(both_bounds(df, key), key), True)
    middle = split_range(key, keys, 2)[0].end
    (mid,) = df.where(key.column() <= key.literal(middle)).agg(F.max(offset.column())).first()
    return Halves(df, offset, BatchRange(lo, mid, True), BatchRange(mid, hi))
