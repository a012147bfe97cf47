"""The streaming source: ``spark.readStream.format("tidemark")``.

Spark keeps the offsets in its checkpoint and replays unfinished batches; the reader
only finds the table's end and turns a pair of offsets into tasks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import Any
from weakref import WeakSet

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

import tidemark
from tidemark.functions.offset_column import OffsetColumn
from tidemark.functions.offset_json import offset_bounds, offset_dict
from tidemark.plans.progress import Span, batch_range, first_span, next_span
from tidemark.plans.settings import OFFSET_FIELD, TIME_ZONE, Settings
from tidemark.sources.bounds_index import BoundsIndex
from tidemark.sources.dbapi import DbApiTable, Slice
from tidemark.sources.parquet_footers import FooterIndex, IndexedFiles, read_pieces, table_shape

#: Option that says a query runs on a trigger that comes again, so that steps add up.
STEPPING = "stepping"


class TidemarkSource(DataSource):
    """A growing table as a stream, tracked by one increasing column.

    ``path`` reads a Parquet folder. ``dbapi`` and ``dbtable`` read a database table,
    whose schema the user declares with ``.schema(...)``. Tracking is set by
    ``offset.field``, ``start.offset`` and ``offset.field.date.format``; ``columns``
    keeps only the named columns, since a stream reader receives no projection.
    A declared schema must be the table's; ``read_stream`` declares the one Spark's own
    Parquet reader finds, which a table partitioned by folders needs. ``rowsPerBatch`` ends Parquet batches after about that many
    rows: one step for each trigger, so it must come with ``stepping``, which says that
    triggers follow (``drain_stream`` sees to it for runs that end by themselves).
    """

    @classmethod
    def name(cls) -> str:
        return "tidemark"

    @property
    def _given(self) -> dict[str, str]:
        return {key.lower(): value for key, value in self.options.items()}

    def schema(self) -> T.StructType:
        if "path" not in self._given:
            raise ValueError("A database table needs its schema declared with .schema(...).")
        stored, folders = table_shape(self._given["path"])
        if folders:
            raise ValueError(
                f"The table is partitioned by {sorted(folders)}: use read_stream, or declare the "
                "schema that spark.read.parquet finds."
            )
        for field in stored:
            nano = pa.types.is_timestamp(field.type) and field.type.unit == "ns"
            if nano and field.name.lower() == self._given.get(OFFSET_FIELD, "").lower():
                raise ValueError("Spark has no nanosecond timestamps: store microseconds.")
        return _spark_schema(self._kept(stored))

    def _check_steps(self) -> None:
        given = self._given
        if "rowsperbatch" in given and given.get(STEPPING, "").lower() != "true":
            raise ValueError(
                "With 'rowsPerBatch' a run that ends by itself ends after one step. Start it through "
                f"drain_stream, or set '{STEPPING}' to 'true' for a trigger that comes again."
            )

    def _kept(self, schema: pa.Schema, folders: set[str] = frozenset()) -> pa.Schema:
        wanted = [c.strip() for c in self._given.get("columns", "").split(",") if c.strip()]
        if not wanted:
            return schema
        missing = sorted(set(wanted) - set(schema.names) - folders)
        if missing:
            raise ValueError(f"Columns {missing} are not in the table: {schema.names}.")
        return pa.schema([schema.field(c) for c in wanted if c in schema.names])

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        if schema is None:
            raise ValueError("The schema is missing.")
        given = self._given
        if "path" in given:
            self._check_steps()
            stored, folders = table_shape(given["path"])
            _check_declared(schema, _spark_schema(self._kept(stored, folders)), folders)
            return ParquetStreamReader(given, schema, _spark_schema(stored))
        if "dbapi" in given:
            if not given.get("dbtable"):
                raise ValueError("Option 'dbtable' is missing.")
            return DbApiStreamReader(given, schema)
        if given.get("url", "").startswith("jdbc:"):
            raise ValueError(
                "A stream reader runs without a JVM: follow a JDBC table with LandedStream, "
                "or name a Python driver with 'dbapi'."
            )
        raise ValueError("Option 'path' or 'dbapi' is missing.")


class JdbcNamedSource(TidemarkSource):
    """The same source under the name existing jobs ask for."""

    @classmethod
    def name(cls) -> str:
        # Fixed value: the short name of the format.
        return "jdbc-streaming-v1"


def _spark_schema(schema: pa.Schema) -> T.StructType:
    # Another file may hold NULLs where this one has none.
    return from_arrow_schema(schema, prefer_timestamp_ntz=True).toNullable()


def _check_declared(declared: T.StructType, stored: T.StructType, folders: set[str]) -> None:
    """A declared schema changes nothing but the types of folders, so one that differs is an error."""
    want = [(f.name, f.dataType) for f in declared.toNullable() if f.name not in folders - set(stored.names)]
    have = [(f.name, f.dataType) for f in stored.fields]
    if want != have:
        raise ValueError(
            f"The declared schema {declared.simpleString()} differs from the table's "
            f"{stored.simpleString()}."
        )


class OffsetStreamReader(DataSourceStreamReader):
    """Offsets of a stream; subclasses find the table's bounds and plan a range."""

    def __init__(self, given: dict[str, str], schema: T.StructType, full: T.StructType) -> None:
        self._settings = Settings.of(given, full)
        self._field = self._settings.offset.name
        self._schema = schema
        self._current: Span | None = None

    def bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        raise NotImplementedError

    def plan(self, start: str, end: str, inclusive: bool) -> Sequence[InputPartition]:
        raise NotImplementedError

    def shorten(self, span: Span, floor: str | None) -> Span:
        """Extension: ``span``, or a first part of it."""
        return span

    def initialOffset(self) -> dict[str, Any]:
        return offset_dict(self._field)

    def latestOffset(self) -> dict[str, Any]:
        if self._current is None:
            floor = self._settings.start
            moved = first_span(floor, *self.bounds(floor))
        else:
            floor = self._current.end
            moved = next_span(self._settings.offset, self._current, self.bounds(floor)[1])
        if moved is not None:
            self._current = self.shorten(moved, floor)
        return offset_dict(self._field, *(self._current or ()))

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> Sequence[InputPartition]:
        previous = self._span(start)
        span = self._span(end)
        if span is None:
            if previous is not None:
                raise ValueError(f"Invalid range: from {start} to {end}.")
            return []
        # After a restart Spark asks for the checkpointed span first: go on from there.
        self._current = span
        if previous == span:
            return []
        batch = batch_range(previous, span)
        return self.plan(batch.start, batch.end, batch.inclusive)

    def _span(self, offset: dict[str, Any]) -> Span | None:
        start, end = offset_bounds(offset, self._field)
        if start is None and end is None:
            return None
        if start is None or end is None:
            raise ValueError(f"Invalid range: {offset} needs both bounds.")
        return Span(start, end)


class ParquetStreamReader(OffsetStreamReader):
    """A Parquet folder: bounds from footers, one task per run of row groups."""

    def __init__(self, given: dict[str, str], schema: T.StructType, stored: T.StructType) -> None:
        self._uri = given["path"]
        super().__init__(given, schema, stored)
        self._offset_type = to_arrow_schema(T.StructType([_field_of(self._settings)])).field(0).type
        self._size = int(given["taskbytes"]) if "taskbytes" in given else None
        self._cores = int(given.get("cores", os.cpu_count() or 1))
        self._rows_per_batch = int(given.get("rowsperbatch", "0"))
        self._index_folder = given.get("index")

    @cached_property
    def _index(self) -> FooterIndex:
        if self._index_folder:
            return IndexedFiles(self._uri, self._settings.offset, self._index_folder)
        return FooterIndex(self._uri, self._settings.offset)

    def __getstate__(self) -> dict[str, Any]:
        # Tasks need the settings only, not what the planner has learnt about the files.
        return {k: v for k, v in self.__dict__.items() if k != "_index"}

    def bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        self._index.refresh()
        return self._index.bounds(at_least)

    def plan(self, start: str, end: str, inclusive: bool) -> Sequence[InputPartition]:
        if not self._index.loaded:
            self._index.refresh()
        tasks = self._index.pieces(start, end, inclusive, self._size, self._cores)
        return [
            InputPartition((tuple(map(tuple, pieces)), start, end, inclusive)) for pieces in tasks
        ]

    def shorten(self, span: Span, floor: str | None) -> Span:
        if not self._rows_per_batch:
            return span
        end = self._index.end_after(self._rows_per_batch, floor)
        parse = self._settings.offset.parse
        if end is None or parse(end) >= parse(span.end) or parse(end) < parse(span.start):
            return span
        return Span(span.start, end)

    def commit(self, end: dict[str, Any]) -> None:
        span = self._span(end)
        if span is not None:
            self._index.forget(span.end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        pieces, start, end, inclusive = partition.value
        low, high = self._scalar(start), self._scalar(end)
        above = pc.greater_equal if inclusive else pc.greater

        def inside(offsets: pa.Array) -> pa.Array:
            return pc.and_(above(offsets, low), pc.less_equal(offsets, high))

        schema = to_arrow_schema(self._schema)
        return read_pieces(self._uri, pieces, schema, self._field, self._offset_type, inside)

    def _scalar(self, text: str) -> pa.Scalar:
        return pa.scalar(self._settings.offset.parse(text), type=self._offset_type)


def _field_of(settings: Settings) -> T.StructField:
    return T.StructField(settings.offset.name, settings.offset.data_type)


class DbApiStreamReader(OffsetStreamReader):
    """A database table: bounds by query, one connection per sub-range."""

    def __init__(self, given: dict[str, str], schema: T.StructType) -> None:
        connect = {k for k in given if k.startswith("dbapi.")}
        super().__init__({k: v for k, v in given.items() if k not in connect}, schema, schema)
        self._db = DbApiTable(given, self._settings.offset, schema.names)

    def bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        return self._db.bounds(at_least)

    def plan(self, start: str, end: str, inclusive: bool) -> Sequence[InputPartition]:
        return [InputPartition(tuple(s)) for s in self._db.slices(start, end, inclusive)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self._schema)
        for rows in self._db.read(Slice(*partition.value)):
            columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)]
            yield pa.record_batch(columns, schema=schema)


_REGISTERED: WeakSet[SparkSession] = WeakSet()


def register(spark: SparkSession) -> None:
    """Make the source known to ``spark`` under its names.

    Its classes travel to the executors with the query, so nothing needs installing there.
    """
    if spark in _REGISTERED:
        return
    _REGISTERED.add(spark)
    cloudpickle.register_pickle_by_value(tidemark)
    try:
        for source in (TidemarkSource, JdbcNamedSource):
            spark.dataSource.register(source)
    finally:
        cloudpickle.unregister_pickle_by_value(tidemark)


def read_stream(
    spark: SparkSession, path: str, offset_field: str, **options: str
) -> DataFrame:
    """A Parquet folder as a streaming DataFrame; ``path`` means what it means to Spark.

    The schema is that of Spark's own reader, folders included, a zoneless ``start.offset`` is
    in the session's time zone, and tasks follow the session's cores. ``index`` names a shared folder for the
    bounds of the files (``BoundsIndex``): Spark jobs bring it up to date here, and while the stream
    runs, ``BoundsIndex.following`` does; the planner then opens no file of the table.
    """
    register(spark)
    schema = spark.read.parquet(path).schema
    given = {k.lower(): v for k, v in options.items()}
    if "index" in given:
        offset = OffsetColumn.of(schema, offset_field)
        BoundsIndex(spark, path, given["index"], offset, schema).refresh()
    wanted = [c.strip() for c in given.get("columns", "").split(",") if c.strip()]
    missing = sorted(set(wanted) - set(schema.names))
    if missing:
        raise ValueError(f"Columns {missing} are not in the table: {schema.names}.")
    kept = T.StructType([schema[c] for c in wanted]) if wanted else schema
    own = {
        "cores": str(spark.sparkContext.defaultParallelism),
        TIME_ZONE: spark.conf.get("spark.sql.session.timeZone"),
    }
    own = {k: v for k, v in own.items() if k.lower() not in given}
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.format(TidemarkSource.name()).option(OFFSET_FIELD, offset_field)
    reader = reader.schema(kept).options(**{**own, **options})
    return reader.option("path", system.makeQualified(place).toString()).load()


def drain_stream(start: Callable[[], StreamingQuery]) -> int:
    """Run a query that ends by itself until a run finds nothing new; how many runs that took.

    ``start`` starts it, always with the same checkpoint, on an ``availableNow`` trigger. Each run takes
    one step of ``rowsPerBatch``, so together they take everything, in batches of that size.
    """
    runs = 0
    while True:
        query = start()
        query.awaitTermination()
        runs += 1
        steps = [s for p in query.recentProgress for s in p.sources]
        if all(s.startOffset == s.endOffset for s in steps):
            return runs
