"""Incremental batches over native Spark reads, with a durable offset log.

This is the path for large tables: each batch is an ordinary DataFrame, so Spark
plans the scan, pushes filters down and spreads the read over executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial
from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.offset_column import STRING, OffsetColumn
from tidemark.operators.batch_cuts import batch_ends
from tidemark.operators.ranges import BatchRange, read_nothing
from tidemark.operators.tagging import dealt_by_batch
from tidemark.plans.progress import Span, batch_range, first_span, next_span
from tidemark.plans.schema_history import check_evolution, conform
from tidemark.plans.settings import TIME_ZONE, Settings
from tidemark.streaming.lease import Lease
from tidemark.streaming.offset_log import OffsetLog
from tidemark.streaming.sinks import CommittedSink, parquet_sink

__all__ = ["Delivered", "IncrementalFeed", "Sink", "Table", "parquet_sink"]

#: A function ``(batch, batch_id)``, or a sink whose batches count by their commits.
Sink = Callable[[DataFrame, int], None] | CommittedSink

#: A table's files lie across batches if a block holds rows of more than this many, on average.
SPREAD = 2.0
_STAGED = "_batch"


class Table(Protocol):
    """What a feed asks of a table."""

    strings_ordered_by_bytes: bool

    @property
    def schema(self) -> T.StructType: ...

    def frame(self) -> DataFrame: ...

    def bounds(
        self, offset: OffsetColumn, at_least: str | None = None
    ) -> tuple[str | None, str | None]: ...

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame: ...

    def pinned(self) -> Table:
        """The same table for many reads, as it is now: what it lists it lists once."""
        ...

    def ranked_ends(self, offset: OffsetColumn, batch: BatchRange, rows: int) -> list[str]:
        """Where to end batches of at most ``rows`` rows, in an order that only the table knows."""
        ...


class Delivered(NamedTuple):
    """One batch handed to the sink."""

    batch_id: int
    batch: BatchRange


class IncrementalFeed:
    """Delivers a growing table to a sink, each row once, in batches that resume.

    A batch is delivered at least once: after a crash the unfinished one runs again
    with the same id and bounds, so a sink that overwrites by ``batch_id`` (such as
    ``parquet_sink``) ends up with every row exactly once. While a feed runs it holds
    the log's lease: a second one is refused, and one that lost its lease stops before
    it delivers or commits. Of a ``committed_sink`` only what has a commit counts, so that not even one that
    writes on after it lost its lease is seen.

    ``one_pass`` cuts a backlog of several batches in one scan: every row is written aside with the number of its
    batch, and batches are delivered from there, in order. Without it each batch is a scan with the
    range pushed down, which is cheaper where files are clustered by the offset. Unless told, a table with
    an index decides by how many batches its blocks lie across; others scan for each batch.

    The log keeps the table's schema. A later run may find more columns, and types that hold more values: what it delivers
    from then on has them, an unfinished batch does not. Columns that are gone or hold less are refused.

    ``agreed``: lease and log rest on puts and listings alone, not on renames or exclusive creation; unless told, for logs on
    object stores. Use a ``committed_sink`` there: other sinks replace a batch's folder, which is no single step.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: Table,
        options: Mapping[str, str],
        log_folder: str,
        rows_per_batch: int | None = None,
        retain: int | None = None,
        lease_seconds: float = 120.0,
        one_pass: bool | None = None,
        agreed: bool | None = None,
    ) -> None:
        self._spark = spark
        self._log_folder = log_folder.rstrip("/")
        self._one_pass = one_pass
        zone = {TIME_ZONE: spark.conf.get("spark.sql.session.timeZone")}
        self._settings = Settings.of({**zone, **options}, table.schema)
        self._offset = self._settings.offset
        self._table = table
        self._rows_per_batch = rows_per_batch
        self.log = OffsetLog(spark, log_folder, self._offset.name, retain, agreed)
        self._lease = Lease(spark, log_folder, lease_seconds, agreed)

    @property
    def _ordered_by_bytes(self) -> bool:
        if self._offset.kind != STRING:
            return True
        return self._table.strings_ordered_by_bytes and self._offset.ordered_by_bytes

    @property
    def last_offset(self) -> Span | None:
        """The last span written to the log, finished or not."""
        latest = self.log.latest()
        return latest and latest[1]

    def run_available(self, sink: Sink) -> list[Delivered]:
        """Deliver what an interrupted run left, then all that is there now."""
        with self._lease:
            return self._run(sink)

    def _run(self, sink: Sink) -> list[Delivered]:
        done: list[Delivered] = []
        known = self.log.schema()
        if known is not None:
            check_evolution(known, self._table.schema)
        latest = self.log.latest()
        batch_id, current = -1, None
        if latest:
            batch_id, current, finished = latest
            if not finished:
                # As it was planned, columns included.
                done.append(self._deliver(self._table, sink, batch_id, current, schema=self.log.schema(batch_id)))
        target = self._movement(current)
        if target is None:
            return done
        # What the target covers is there already: one listing serves the plan and every batch.
        table = self._table.pinned()
        ends = self._ends(table, current, target)
        staged = self._staged(table, batch_range(current, target), ends)
        try:
            for i, end in enumerate(ends):
                start = target.start if current is None else current.end
                batch_id, current = batch_id + 1, Span(start, end)
                self._lease.check()
                self.log.plan(batch_id, current, self._table.schema)
                done.append(self._deliver(table, sink, batch_id, current, staged and f"{staged}/{_STAGED}={i}"))
        finally:
            if staged:
                self._delete(staged)
        return done

    def _staged(self, table: Table, whole: BatchRange, ends: list[str]) -> str | None:
        """The folder where the rows of ``whole`` lie by batch, if one pass is to deal them."""
        if len(ends) < 2 or not self._wants_one_pass(ends):
            return None
        # What a run that broke off has left; nobody else writes here while the lease holds.
        self._delete(f"{self._log_folder}/staged")
        folder = f"{self._log_folder}/staged/{self._lease.epoch}"
        rows = table.read(self._offset, whole)
        dealt_by_batch(rows, self._offset, ends, _STAGED).write.partitionBy(_STAGED).parquet(folder)
        return folder

    def _wants_one_pass(self, ends: list[str]) -> bool:
        if self._one_pass is not None:
            return self._one_pass
        index = getattr(self._table, "index", lambda _: None)(self._offset)
        return index is not None and index.spread(ends) > SPREAD

    def _delete(self, folder: str) -> None:
        place = self._spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(place, True)

    def _read_staged(self, table: Table, folder: str) -> DataFrame:
        place = self._spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not place.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(place):
            return read_nothing(table.frame())
        return self._spark.read.schema(table.schema).parquet(folder)

    def _movement(self, current: Span | None) -> Span | None:
        if current is None:
            start = self._settings.start
            return first_span(start, *self._table.bounds(self._offset, start))
        _, most = self._table.bounds(self._offset, current.end)
        moved = next_span(self._offset, current, most)
        if moved is not None and not self._ordered_by_bytes:
            # Another text can be the same string to a collation: only a row beyond the end is movement.
            if not self._table.read(self._offset, BatchRange(*moved)).limit(1).count():
                return None
        return moved

    def _ends(self, table: Table, current: Span | None, target: Span) -> list[str]:
        if self._rows_per_batch is None:
            return [target.end]
        whole = batch_range(current, target)
        if not self._ordered_by_bytes:
            return table.ranked_ends(self._offset, whole, self._rows_per_batch)
        read = partial(table.read, self._offset)
        return batch_ends(read, self._offset, whole, self._rows_per_batch)

    def _deliver(
        self, table: Table, sink: Sink, batch_id: int, span: Span, staged: str | None = None, schema: T.StructType | None = None
    ) -> Delivered:
        # Every batch but the first continues where another one ended.
        batch = BatchRange(span.start, span.end, inclusive=batch_id == 0)
        self._lease.check()
        rows = table.read(self._offset, batch) if staged is None else self._read_staged(table, staged)
        if schema is not None:
            rows = conform(rows, schema)
        if isinstance(sink, CommittedSink):
            output = sink.write(rows, batch_id, self._lease.epoch)._asdict()
            self._lease.check()
            if not self.log.committed(batch_id):  # by a runner that held the lease before, of the same rows
                self.log.commit(batch_id, output)
            return Delivered(batch_id, batch)
        if staged is not None and hasattr(sink, "adopt") and not self.log.agreed:
            sink.adopt(self._spark, staged, batch_id)
        else:
            sink(rows, batch_id)
        self._lease.check()
        self.log.commit(batch_id)
        return Delivered(batch_id, batch)
