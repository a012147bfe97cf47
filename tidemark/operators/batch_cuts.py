"""Extension: where to end batches of at most ``rows`` rows, without splitting ties."""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from decimal import Decimal
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import (
    DATE,
    STRING,
    TIMESTAMP,
    TIMESTAMP_NTZ,
    OffsetColumn,
)
from tidemark.operators.ranges import BatchRange
from tidemark.plans.workspace import shared_folder

#: Buckets of the first count; and how many of a later one for each batch that a bucket holds.
FIRST_BUCKETS = 1 << 14
FINER = 8
_FEWEST, _MOST = 16, 1 << 14

# Bytes of a string that take part in its key: with their number, 51 bits are exact in a double.
_KEY_BYTES = 6
_LARGEST = 1.7976931348623157e308


class Bucket(NamedTuple):
    """A run of neighbouring offsets: how many rows, the least and the largest of them."""

    rows: int
    least: str
    most: str


class _Ruler(NamedTuple):
    """Divides the offsets between two bounds into ``parts`` of equal width."""

    low: Any
    scale: float
    parts: int
    skip: int


def batch_ends(
    read: Callable[[BatchRange], DataFrame], offset: OffsetColumn, batch: BatchRange, rows: int
) -> list[str]:
    """End offsets that cut ``batch`` into consecutive batches of at most ``rows`` rows.

    ``read`` gives the rows of a range, so that the table decides how a read is spread. Each round
    reads the offset column once and counts it into buckets, which combines map-side; only bucket
    totals reach the driver, a few for each batch. All buckets that hold more than ``rows`` rows are
    counted again in the next round, together and each between its own least and largest offset,
    until they are single offset values: rows of one value stay together, however many they are.
    """
    if rows < 1:
        raise ValueError("A batch needs at least one row.")
    frame = read(batch).select(offset.column()).withColumn("_cut", F.lit(0).cast("long"))
    line = [Bucket(rows + 1, batch.start, batch.end)]
    heavy = [0] if batch.start != batch.end else []
    while heavy:
        rulers = []
        for at in heavy:
            bucket = line[at]
            parts = math.ceil(FINER * bucket.rows / rows)
            parts = FIRST_BUCKETS if len(line) == 1 else min(_MOST, max(_FEWEST, parts))
            rulers.append(_ruler(offset, bucket.least, bucket.most, parts))
        frame = _divided(frame, offset, rulers, heavy)
        found = _counted(frame, offset)
        # Buckets are told by the ruler and their place on it, in order.
        finer: list[list[tuple[int, Bucket]]] = [[] for _ in heavy]
        for cut, bucket in found:
            finer[cut >> 16].append((cut, bucket))
        line, keys, heavy = _replaced(line, heavy, finer, rows)
        frame = _renumbered(frame, keys)
    return _packed(line, batch.end, rows)


def run_size(rows: int) -> int:
    """Rows of a run of values, several of which make a batch of ``rows`` rows."""
    if rows < 1:
        raise ValueError("A batch needs at least one row.")
    return max(1, rows // FINER)


def pack_runs(runs: list[tuple[int, str]], end: str, rows: int) -> list[str]:
    """Ends of batches of at most ``rows`` rows out of runs (rows, end) in order."""
    return _packed([Bucket(n, most, most) for n, most in runs], end, rows)


def ranked_ends(df: DataFrame, offset: OffsetColumn, rows: int, end: str) -> list[str]:
    """``batch_ends`` in Spark's own order of the column, whatever it is: collated strings as well.

    Values are counted, ordered over all tasks, and numbered by the rows up to each: a task's rows are
    summed up, the totals of the tasks are added up on the driver, and each task goes on from the sum of those before
    it. Runs of neighbouring values come to the driver, a few for each batch. Equal values stay together,
    as the column's collation has them; a run is told by one of its values.
    """
    unit = run_size(rows)
    spark, c = df.sparkSession, offset.column()
    counted = df.groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.repartitionByRange("v").sortWithinPartitions("v").withColumn("task", F.spark_partition_id())
    path = shared_folder(spark, "ranks")
    ordered.write.parquet(path)
    told = spark.read.schema(ordered.schema).parquet(path)
    sums = sorted(told.groupBy("task").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["task"])
    before = list(zip((r["task"] for r in sums), accumulate((r["n"] for r in sums), initial=0)))
    within = Window.partitionBy("task").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = told.join(F.broadcast(spark.createDataFrame(before, "task int, before long")), "task")
    upto = upto.withColumn("upto", F.col("before") + F.sum("n").over(within))
    part, light = F.floor((F.col("upto") - 1) / unit), (F.col("n") < unit).cast("int")
    runs = upto.groupBy(part.alias("part"), light.alias("light")).agg(F.sum("n").alias("n"), F.max("v").alias("most"), F.max("upto").alias("last"))
    found = sorted(runs.collect(), key=lambda r: r["last"])
    return pack_runs([(r["n"], r["most"]) for r in found], end, rows)


def _replaced(line: list[Bucket], heavy: list[int], finer: list, rows: int):
    """``line`` with its heavy buckets divided; which of the new ones are heavy, and their keys."""
    out: list[Bucket] = []
    again, keys = [], {}
    parts = dict(zip(heavy, finer))
    for at, bucket in enumerate(line):
        for key, part in parts.get(at, [(None, bucket)]):
            if key is not None and part.rows > rows and part.least != part.most:
                keys[key] = len(out)
                again.append(len(out))
            out.append(part)
    return out, keys, again


def _packed(line: list[Bucket], end: str, rows: int) -> list[str]:
    """Ends of batches of neighbouring buckets, each as full as may be."""
    ends: list[str] = []
    open_rows, open_end = 0, None
    for bucket in line:
        if open_rows and open_rows + bucket.rows > rows:
            ends.append(open_end)
            open_rows = 0
        open_rows, open_end = open_rows + bucket.rows, bucket.most
    return [*ends, end]


# -- counting ---------------------------------------------------------------------


def _divided(frame: DataFrame, offset: OffsetColumn, rulers: list[_Ruler], keys: list[int]) -> DataFrame:
    """The rows of the buckets ``keys`` with the finer bucket each falls into.

    There are as many rulers as heavy buckets, a few for each batch planned, so they are broadcast.
    """
    fields = [
        T.StructField("_cut", T.LongType()),
        T.StructField("_ruler", T.LongType()),
        T.StructField("_low", _point_type(offset)),
        T.StructField("_scale", T.DoubleType()),
        T.StructField("_parts", T.LongType()),
        T.StructField("_skip", T.IntegerType()),
    ]
    values = [(k, n, r.low, r.scale, r.parts, r.skip) for n, (k, r) in enumerate(zip(keys, rulers))]
    known = frame.sparkSession.createDataFrame(values, T.StructType(fields))
    joined = frame.join(F.broadcast(known), "_cut")
    position = _position(offset) * F.col("_scale")
    place = F.least(F.greatest(F.floor(position), F.lit(0)), F.col("_parts") - 1)
    if _floating(offset):  # what is infinite stands apart
        c = offset.column().cast("double")
        place = F.when(c == math.inf, F.col("_parts")).when(c == -math.inf, -1).otherwise(place)
    cut = F.shiftleft(F.col("_ruler"), 16) + place + 1
    return joined.select(offset.column(), cut.cast("long").alias("_cut"))


def _counted(frame: DataFrame, offset: OffsetColumn) -> list[tuple[int, Bucket]]:
    c = offset.column()
    counted = frame.groupBy("_cut").agg(
        F.count(F.lit(1)).alias("rows"),
        offset.carrier(F.min(c)).alias("least"),
        offset.carrier(F.max(c)).alias("most"),
    )
    carried = offset.from_carrier
    return [
        (r["_cut"], Bucket(r["rows"], carried(r["least"]), carried(r["most"])))
        for r in sorted(counted.collect(), key=lambda r: r["_cut"])
    ]


def _renumbered(frame: DataFrame, keys: dict[int, int]) -> DataFrame:
    """The rows of the buckets that are divided next, numbered by their place in the line."""
    if not keys:
        return frame
    known = frame.sparkSession.createDataFrame(list(keys.items()), "_cut long, _next long")
    return frame.join(F.broadcast(known), "_cut").drop("_cut").withColumnRenamed("_next", "_cut")


# -- positions --------------------------------------------------------------------
#
# A double that grows with the offset, from 0 at the low bound. It need not tell close offsets
# apart, only never order two of them the other way round, and tell the bounds apart.


def _floating(offset: OffsetColumn) -> bool:
    return isinstance(offset.data_type, (T.FloatType, T.DoubleType))


def _point_type(offset: OffsetColumn) -> T.DataType:
    if offset.kind == DATE:
        return T.DateType()
    if isinstance(offset.data_type, T.DecimalType):
        return offset.data_type
    if offset.integral:
        return T.DecimalType(20, 0)
    return T.DoubleType() if _floating(offset) else T.LongType()


def _position(offset: OffsetColumn) -> Column:
    c, low = offset.column(), F.col("_low")
    if offset.kind == STRING:
        return (_string_number(c) - low).cast("double")
    if offset.kind == DATE:
        return F.datediff(c, low).cast("double")
    if offset.kind == TIMESTAMP:
        return (F.unix_micros(c) - low).cast("double")
    if offset.kind == TIMESTAMP_NTZ:
        return (_wall_clock_micros(c) - low).cast("double")
    if offset.integral:
        return (c.cast("decimal(20,0)") - low).cast("double")
    if isinstance(offset.data_type, T.DecimalType):
        # In the column's own type; only bounds too far apart for it go through doubles.
        return F.coalesce(F.try_subtract(c, low).cast("double"), c.cast("double") - low.cast("double"))
    # Halved, since the distance of two doubles may not fit in one.
    return c.cast("double") / 2 - low / 2


def _ruler(offset: OffsetColumn, least: str, most: str, parts: int) -> _Ruler:
    skip = 0
    if offset.kind == STRING:
        low_bytes, high_bytes = least.encode(), most.encode()
        skip = len(os.path.commonprefix([low_bytes, high_bytes]))
        low, high = _number_of(low_bytes[skip:]), _number_of(high_bytes[skip:])
        span = float(high - low)
    else:
        low, high = offset.to_point(least), offset.to_point(most)
        if _floating(offset):
            low, high = max(low, -_LARGEST), min(high, _LARGEST)
            span = high / 2 - low / 2
        else:
            span = float(high - low)
        if offset.kind == DATE:
            low = offset.parse(least)
    return _Ruler(_carried(offset, low), parts / span if span > parts / _LARGEST else 1.0, parts, skip)


def _carried(offset: OffsetColumn, low: Any) -> Any:
    if offset.integral:
        return Decimal(low)
    return low


def _wall_clock_micros(c: Column) -> Column:
    """Microseconds of a zoneless timestamp, without a detour through the session's zone."""
    minutes = (F.unix_date(F.to_date(c)).cast("long") * 24 + F.hour(c)) * 60 + F.minute(c)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")


def _string_number(c: Column) -> Column:
    """The bytes after the prefix that all strings between the bounds share, then their number, so
    that a string comes before its own continuation by zero bytes."""
    window = F.substring(c.cast("binary"), F.col("_skip") + 1, F.lit(_KEY_BYTES))
    number = F.conv(F.rpad(F.hex(window), 2 * _KEY_BYTES, "0"), 16, 10).cast("long")
    return number * (_KEY_BYTES + 1) + F.octet_length(window)


def _number_of(data: bytes) -> int:
    window = data[:_KEY_BYTES]
    return int.from_bytes(window.ljust(_KEY_BYTES, b"\0"), "big") * (_KEY_BYTES + 1) + len(window)
