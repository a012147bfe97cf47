"""Where batches go: Parquet by batch, and Parquet of which only committed attempts count."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.ranges import BatchRange, range_predicate
from tidemark.operators.tagging import batch_number
from tidemark.plans.progress import Span
from tidemark.streaming.offset_log import OffsetLog

_BATCH = "batch_id"
_ATTEMPT = "attempt"


class ParquetSink:
    """Replaces ``batch_id=<n>`` below a folder, so a repeated batch counts once."""

    def __init__(self, folder: str) -> None:
        self._folder = folder.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self._folder}/{_BATCH}={batch_id}")

    def adopt(self, spark: SparkSession, staged: str, batch_id: int) -> None:
        """Take a batch that is written already, by moving its folder."""
        _move(spark, staged, f"{self._folder}/{_BATCH}={batch_id}")


def parquet_sink(folder: str) -> ParquetSink:
    """A sink that replaces ``batch_id=<n>`` below ``folder``, so a repeated batch counts once."""
    return ParquetSink(folder)


class Attempt(NamedTuple):
    """What a commit says of the output it makes count: where it lies, its rows, and the sum of their hashes."""

    output: str
    rows: int
    hash_sum: str


class CommittedSink:
    """Parquet in a folder for each attempt; the log's commit names the one that counts.

    Attempts never share a folder, so a runner that lost its lease and writes on spoils nothing: its attempt has
    no commit, and ``read_committed`` does not see it. A batch has one commit, whoever wrote it.
    The commit also keeps the number of rows and an order-free sum of their hashes, which ``late_rows`` compares with the table.
    """

    def __init__(self, folder: str) -> None:
        self._folder = folder.rstrip("/")

    def write(self, batch: DataFrame, batch_id: int, epoch: int) -> Attempt:
        place = f"{_BATCH}={batch_id}/{_ATTEMPT}={epoch}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        batch.observe(seen, *_counted(batch)).write.parquet(f"{self._folder}/{place}")
        return Attempt(place, seen.get["rows"], str(seen.get["hash_sum"] or 0))

    def vacuum(self, log: OffsetLog, spark: SparkSession) -> int:
        """Delete the attempts of committed batches that do not count; how many."""
        counted = {_BATCH + "=" + str(r["batch_id"]): r["output"] for r in log.outputs().collect()}
        files = spark._jvm.org.apache.hadoop.fs
        system = files.Path(self._folder).getFileSystem(spark._jsc.hadoopConfiguration())
        gone = 0
        for name, output in counted.items():
            place = files.Path(f"{self._folder}/{name}")
            for found in system.listStatus(place) if system.exists(place) else ():
                if f"{name}/{found.getPath().getName()}" != output:
                    system.delete(found.getPath(), True)
                    gone += 1
        return gone


def committed_sink(folder: str) -> CommittedSink:
    """A sink below ``folder`` whose batches count from their commit on; read it with ``read_committed``."""
    return CommittedSink(folder)


def _hash_sum(df: DataFrame):
    # Maps have no hash.
    plain = [F.col(f"`{f.name.replace('`', '``')}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.sum(F.xxhash64(*plain).cast("decimal(20,0)"))


def _counted(df: DataFrame) -> list:
    return [F.count(F.lit(1)).alias("rows"), _hash_sum(df).alias("hash_sum")]


def read_committed(spark: SparkSession, folder: str, log: OffsetLog, schema: T.StructType) -> DataFrame:
    """The rows of the attempts that count, with ``batch_id``."""
    place = folder.rstrip("/")
    told = [r["output"] for r in log.outputs().collect()]
    whole = T.StructType([*schema.fields, T.StructField(_BATCH, T.IntegerType()), T.StructField(_ATTEMPT, T.StringType())])
    if not told:
        return spark.createDataFrame([], whole).drop(_ATTEMPT)
    reader = spark.read.schema(whole).option("basePath", place)
    return reader.parquet(*(f"{place}/{output}" for output in told)).drop(_ATTEMPT)


def late_rows(table: DataFrame, offset: OffsetColumn, log: OffsetLog) -> DataFrame:
    """Which delivered spans have gained or lost rows since, or hold others: one row for each such span.

    ``rows_then`` were delivered, ``rows_now`` are there. All spans are compared in one scan of the table up to the last end,
    by number of rows and the sum of their hashes; only batches that a ``CommittedSink`` wrote have these.
    """
    spans = log.outputs().join(log.frame(), "batch_id").select(
        "batch_id", "start_offset", "end_offset", F.col("rows").alias("rows_then"), F.col("hash_sum").cast("decimal(38,0)").alias("hash_then")
    )
    told = [Span(r["start_offset"], r["end_offset"]) for r in log.frame().orderBy("batch_id").collect()]
    numbers = [r["batch_id"] for r in log.frame().orderBy("batch_id").select("batch_id").collect()]
    if not told:
        return spans.select("batch_id", "start_offset", "end_offset", "rows_then", F.col("rows_then").alias("rows_now"))
    whole = BatchRange(told[0].start, told[-1].end, inclusive=numbers[0] == 0)
    inside = table.where(range_predicate(offset, whole))
    tagged = inside.groupBy(batch_number(offset, [s.end for s in told]).alias("place")).agg(
        F.count(F.lit(1)).alias("rows_now"), _hash_sum(table).alias("hash_now")
    )
    now = tagged.select((F.col("place") + numbers[0]).cast("long").alias("batch_id"), "rows_now", "hash_now")
    both = spans.join(now, "batch_id", "left").withColumn("rows_now", F.coalesce("rows_now", F.lit(0)))
    same = (F.col("rows_then") == F.col("rows_now")) & (F.col("hash_then") == F.coalesce("hash_now", F.lit(0)))
    return both.where(~same).select("batch_id", "start_offset", "end_offset", "rows_then", "rows_now")


def _move(spark: SparkSession, source: str, target: str) -> None:
    files = spark._jvm.org.apache.hadoop.fs
    place = files.Path(target)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(place, True)
    system.mkdirs(place.getParent())
    if not system.rename(files.Path(source), place):
        raise RuntimeError(f"{source} could not be moved to {target}.")
