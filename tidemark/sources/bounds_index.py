"""Offset bounds of a Parquet table's files, kept in a table of their own.

A Spark job reads the offset column of files that are new, once, and writes their exact bounds by file
and block (the part of a file that Spark gives to one task): rows, least and largest offset, NULLs, NaNs. Probes,
batch reads and the stream reader open that small table instead of the files.

The index of a column is a folder of Parquet folders ``<number>-<writer>``, in order of their numbers; one counts
once Spark has marked it as written, so nothing is renamed. A later part says which files of earlier ones are
gone. Two writers at once do no harm: what both find is told twice and counts once.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.bounds import END_OFFSET, START_OFFSET, fetch_bound
from tidemark.operators.ranges import BatchRange
from tidemark.operators.tagging import batch_number

#: Names of files that one job is given at most.
PATHS = 5000
#: Parts at which the index is written anew as one.
GATHER_AT = 32

_KEY = ["file", "size", "modified"]
_DONE = "_SUCCESS"
_FULL = "full"


def entry_schema(offset: OffsetColumn) -> T.StructType:
    """One row for each block of a file: its place and its offsets. ``gone`` marks files that are no more."""
    fields = [
        ("file", T.StringType()), ("size", T.LongType()), ("modified", T.LongType()),
        ("start", T.LongType()), ("length", T.LongType()), ("rows", T.LongType()),
        ("least", offset.data_type), ("most", offset.data_type),
        ("nulls", T.LongType()), ("nans", T.LongType()), ("gone", T.BooleanType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def column_folder(folder: str, offset: OffsetColumn) -> str:
    """Where the index of a column lies below ``folder``."""
    return f"{folder.rstrip('/')}/{offset.name.encode().hex()}"


def part_names(names: list[str]) -> list[str]:
    """The parts that count, in order: the last that tells all, and what came after it."""
    parts = sorted(n for n in names if n[:1].isdigit())
    whole = [i for i, n in enumerate(parts) if n.endswith(_FULL)]
    return parts[whole[-1] :] if whole else parts


class BoundsIndex:
    """The bounds of the offset column of the Parquet table at ``path``, kept below ``folder``."""

    def __init__(self, spark: SparkSession, path: str, folder: str, offset: OffsetColumn, schema: T.StructType | None = None) -> None:
        self._spark, self._path, self._offset = spark, path, offset
        self._schema = schema or spark.read.parquet(path).schema
        self._folder = column_folder(folder, offset)
        self._files = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._at(""))
        # What was asked last, of which parts, and the answer.
        self._told: tuple[tuple, tuple[str | None, str | None]] | None = None

    # -- upkeep --------------------------------------------------------------

    def refresh(self) -> int:
        """Bring the index up to the files that are there; how many were read for it."""
        listed = _listed(self._spark, self._path).withColumn("there", F.lit(True))
        known = self.live().select(*_KEY).distinct().withColumn("known", F.lit(True))
        changed = listed.join(known, _KEY, "full").where("there IS NULL OR known IS NULL").select(*_KEY, "there").collect()
        fresh = [tuple(r[c] for c in _KEY) for r in changed if r["there"]]
        lost = [tuple(r[c] for c in _KEY) for r in changed if not r["there"]]
        if not changed:
            return 0
        # One column of the new files, whatever number of jobs their names are dealt over.
        parts = [self._measured(fresh[i : i + PATHS]) for i in range(0, len(fresh), PATHS)]
        if lost:
            parts.append(self._written(self._files_frame(lost).withColumn("gone", F.lit(True))))
        number = self._next()
        for i, part in enumerate(parts):
            self._write(part, number + i)
        if len(self._parts()) >= GATHER_AT:
            self.gather()
        return len(fresh)

    def gather(self) -> None:
        """Write all that counts as one part; parts before an earlier such one are deleted."""
        whole = [n for n in self._names() if n.endswith(_FULL)]
        self._write(self._written(self.live()).coalesce(1), self._next(), _FULL)
        for name in self._names():
            if whole and name < max(whole):
                self._fs.delete(self._at(name), True)

    def _files_frame(self, files: list[tuple]) -> DataFrame:
        return self._spark.createDataFrame(files, "file string, size long, modified long")

    def _measured(self, fresh: list[tuple]) -> DataFrame:
        """The entries of some new files; one without rows has an entry too, so that it is known."""
        names = [file for file, _, _ in fresh]
        meta = F.col("_metadata")
        rows = self._spark.read.schema(self._schema).parquet(self._path).where(meta["file_path"].isin(names))
        raw, c = self._offset.column(), self._offset.orderable()
        blocks = rows.select(
            meta["file_path"].alias("file"), meta["file_size"].alias("size"), F.unix_micros(meta["file_modification_time"]).alias("modified"),
            meta["file_block_start"].alias("start"), meta["file_block_length"].alias("length"), raw.alias("_raw"), c.alias("_c"),
        ).groupBy(*_KEY, "start", "length").agg(
            F.count("*").alias("rows"), F.min("_c").alias("least"), F.max("_c").alias("most"),
            F.count_if(F.col("_raw").isNull()).alias("nulls"), F.count_if(F.col("_raw").isNotNull() & F.col("_c").isNull()).alias("nans"),
        )
        return self._written(self._files_frame(fresh).join(blocks, _KEY, "left"))

    def _written(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of an entry; what it lacks is zero, or NULL for bounds."""
        columns = []
        for field in entry_schema(self._offset).fields:
            value: Column = F.col(field.name) if field.name in df.columns else F.lit(None)
            if field.name in ("start", "length", "rows", "nulls", "nans"):
                value = F.coalesce(value, F.lit(0))
            if field.name == "gone":
                value = F.coalesce(value, F.lit(False))
            columns.append(value.cast(field.dataType).alias(field.name))
        return df.select(*columns)

    def _write(self, entries: DataFrame, number: int, mark: str = "part") -> None:
        entries.write.parquet(f"{self._folder}/{number:010d}-{uuid.uuid4().hex[:12]}-{mark}")

    def _at(self, name: str):
        return self._files.Path(f"{self._folder}/{name}" if name else self._folder)

    def _names(self) -> list[str]:
        """Parts that were written to their end."""
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at(""))]
        return [n for n in found if n[:1].isdigit() and self._fs.exists(self._at(f"{n}/{_DONE}"))]

    def _parts(self) -> list[str]:
        return part_names(self._names())

    def _next(self) -> int:
        return max((int(n.split("-")[0]) for n in self._names()), default=-1) + 1

    # -- what it tells -------------------------------------------------------

    def live(self) -> DataFrame:
        """The entries of the files that are there as of the last refresh."""
        schema = entry_schema(self._offset)
        parts = self._parts()
        if not parts:
            return self._spark.createDataFrame([], schema).drop("gone")
        stored = self._spark.read.schema(schema).parquet(*(f"{self._folder}/{p}" for p in parts))
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{10})-[^/]*/[^/]*$", 1).cast("long")
        told = stored.withColumn("number", number)
        ends = told.where("gone").groupBy(*_KEY).agg(F.max("number").alias("ended"))
        alive = told.where("NOT gone").join(ends, _KEY, "left").where("ended IS NULL OR number > ended")
        return alive.dropDuplicates([*_KEY, "start"]).drop("gone", "number", "ended")

    def summary(self) -> DataFrame:
        """One row: files, rows, NULLs and NaNs, and the bounds of the table."""
        return self.live().agg(
            F.count_distinct("file").alias("n_files"),
            *(F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in ("rows", "nulls", "nans")),
            F.min("least").alias(START_OFFSET),
            F.max("most").alias(END_OFFSET),
        )

    def bounds(self, at_least: str | None = None) -> tuple[str | None, str | None]:
        """``(MIN, MAX)`` of the table, or ``(None, MAX)`` of the rows from ``at_least`` on."""
        asked = (*self._parts(), at_least)
        if self._told is None or self._told[0] != asked:
            self._told = asked, self._bounds(at_least)
        return self._told[1]

    def _bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        if at_least is None:
            return fetch_bound(self.summary().select(START_OFFSET, END_OFFSET), self._offset)
        ahead = self.live().where(F.col("most") >= self._offset.literal(at_least))
        return (None, *fetch_bound(ahead.agg(F.max("most").alias(END_OFFSET)), self._offset))

    def files(self, batch: BatchRange) -> list[str]:
        """The files that can hold rows of ``batch``."""
        low, high = self._offset.literal(batch.start), self._offset.literal(batch.end)
        above = F.col("most") >= low if batch.inclusive else F.col("most") > low
        return [r["file"] for r in self.live().where((F.col("least") <= high) & above).select("file").distinct().collect()]

    def spread(self, ends: list[str]) -> float:
        """How many of the batches that end at ``ends`` a block lies in, on average by bytes; 0 if none does."""
        first, last = (batch_number(self._offset, ends, F.col(c)) for c in ("least", "most"))
        low = self._offset.literal(ends[-1])
        inside = self.live().where((F.col("least") <= low) & (F.col("length") > 0))
        told = inside.agg((F.sum((last - first + 1) * F.col("length")) / F.sum("length")).alias("spread")).first()
        return float(told["spread"] or 0.0)

    # -- in the background ---------------------------------------------------

    @contextmanager
    def following(self, seconds: float = 10.0) -> Iterator[Callable[[], int]]:
        """Refresh every ``seconds`` while the block runs; gives a function that refreshes at once."""
        stop, failed = threading.Event(), []

        def run() -> None:
            while not stop.wait(seconds):
                try:
                    self.refresh()
                except Exception as failure:  # noqa: BLE001  told when the block ends
                    failed.append(failure)
                    return

        worker = threading.Thread(target=run, daemon=True)
        worker.start()
        try:
            yield self.refresh
        finally:
            stop.set()
            worker.join()
        if failed:
            raise failed[0]


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as Spark lists them; none is opened."""
    meta = F.col("_metadata")
    return spark.read.format("binaryFile").load(path).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), F.unix_micros(meta["file_modification_time"]).alias("modified")
    )


def only_files(df: DataFrame, files: list[str]) -> DataFrame:
    """The rows of some files; Spark leaves the others out before it makes tasks."""
    return df.where(F.col("_metadata.file_path").isin(files)) if files else df.where(F.lit(False))
