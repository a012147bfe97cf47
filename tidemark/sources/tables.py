"""Tables an incremental read can follow: any batch DataFrame, and Parquet in particular."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.offset_column import DATE, OffsetColumn
from tidemark.operators.batch_cuts import ranked_ends
from tidemark.operators.bounds import both_bounds, end_bound, fetch_bound
from tidemark.operators.ranges import BatchRange, read_range
from tidemark.sources.bounds_index import BoundsIndex, only_files

# Fixed value: how Spark's message begins when a footer holds no bounds.
_NO_STATISTICS = "No min/max found"


class FrameTable:
    """A table given by a function that returns it as a batch DataFrame.

    The function is called for every probe and every read, because a DataFrame
    remembers the files it saw when it was made. The schema is taken once.
    """

    strings_ordered_by_bytes = True

    def __init__(self, load: Callable[[], DataFrame]) -> None:
        self._load = load

    def frame(self) -> DataFrame:
        return self._load()

    def pinned(self) -> FrameTable:
        """This table as it is now; its files are listed once for all reads."""
        frame = self.frame()
        return FrameTable(lambda: frame)

    @cached_property
    def schema(self) -> T.StructType:
        return self.frame().schema

    def bounds(
        self, offset: OffsetColumn, at_least: str | None = None
    ) -> tuple[str | None, str | None]:
        """``(MIN, MAX)`` in one pass, or ``(None, MAX)`` of the rows from ``at_least`` on."""
        if at_least is None:
            return fetch_bound(both_bounds(self.frame(), offset), offset)
        return (None, *fetch_bound(end_bound(self.frame(), offset, at_least), offset))

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        return read_range(self.frame(), offset, batch)

    def ranked_ends(self, offset: OffsetColumn, batch: BatchRange, rows: int) -> list[str]:
        """End offsets of batches of at most ``rows`` rows, for columns whose order only Spark knows."""
        return ranked_ends(self.read(offset, batch), offset, rows, batch.end)


class ParquetTable(FrameTable):
    """A Parquet folder that grows.

    Probes on whole-number and date columns are answered from file footers, so
    finding the end of a large table reads no column data. Other types (and files
    without statistics) scan the one column, where the ``>=`` filter skips every row
    group below the last end.

    With ``index``, a shared folder, the bounds of every file are kept there (``BoundsIndex``): a probe
    reads new files only, whatever their type, and a batch opens only files that can hold some of it. A read from the last
    refresh on sees the files of that refresh, as a probe does.
    """

    def __init__(self, spark: SparkSession, path: str, index: str | None = None) -> None:
        super().__init__(lambda: self._read(spark))
        self._path = path
        self._spark = spark
        self._footers_usable = True
        self._index_folder = index
        self._indexes: dict[OffsetColumn, BoundsIndex] = {}
        self._probed = False

    @cached_property
    def schema(self) -> T.StructType:
        return self._spark.read.parquet(self._path).schema

    def _read(self, session: SparkSession) -> DataFrame:
        return session.read.schema(self.schema).parquet(self._path)

    @cached_property
    def _footer_session(self) -> SparkSession:
        # Aggregates are pushed into Parquet only on the V2 read path; a session of its
        # own keeps these settings away from the user's queries.
        session = self._spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return session

    def index(self, offset: OffsetColumn) -> BoundsIndex | None:
        """The index of ``offset``, if the table keeps one."""
        if self._index_folder is None:
            return None
        if offset not in self._indexes:
            self._indexes[offset] = BoundsIndex(self._spark, self._path, self._index_folder, offset, self.schema)
        return self._indexes[offset]

    def pinned(self) -> FrameTable:
        frame = self.frame()
        return _Pinned(frame, self)

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        return self._read_of(self.frame(), offset, batch)

    def _read_of(self, frame: DataFrame, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        index = self.index(offset)
        # What a log left to be done may be older than the index.
        if index is not None and self._probed:
            frame = only_files(frame, index.files(batch))
        return read_range(frame, offset, batch)

    def bounds(
        self, offset: OffsetColumn, at_least: str | None = None
    ) -> tuple[str | None, str | None]:
        index = self.index(offset)
        if index is not None:
            index.refresh()
            self._probed = True
            return index.bounds(at_least)
        if self._footers_usable and (offset.integral or offset.kind == DATE):
            try:
                return self._footer_bounds(offset, at_least)
            except (PySparkException, Py4JJavaError) as failure:
                # A file without statistics, or with NULL offsets only: scan from now on.
                if _NO_STATISTICS not in str(failure):
                    raise
                self._footers_usable = False
        return super().bounds(offset, at_least)

    def _footer_bounds(
        self, offset: OffsetColumn, at_least: str | None
    ) -> tuple[str | None, str | None]:
        least, most = fetch_bound(both_bounds(self._read(self._footer_session), offset), offset)
        if at_least is None:
            return least, most
        reached = most is not None and offset.parse(most) >= offset.parse(at_least)
        return None, most if reached else None


class _Pinned(FrameTable):
    """A Parquet table whose files were listed once; its index still tells which of them to open."""

    def __init__(self, frame: DataFrame, table: ParquetTable) -> None:
        super().__init__(lambda: frame)
        self._table = table

    def pinned(self) -> FrameTable:
        return self

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        return self._table._read_of(self.frame(), offset, batch)
