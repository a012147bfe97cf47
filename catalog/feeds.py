"""Incremental feeds over growing tables: drain, resume, replay, late, NULL, shrink.

A table grows by raising the offset up to which its rows are visible.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import DERIVED, TRACKED, halves
from tidemark.functions.offset_column import OffsetColumn
from tidemark.functions.offset_json import offset_to_json
from tidemark.operators.bounds import both_bounds, fetch_bound
from tidemark.operators.ranges import BatchRange, split_range
from tidemark.plans.progress import Span
from tidemark.plans.workspace import shared_folder
from tidemark.sources.tables import FrameTable
from tidemark.streaming.feed import IncrementalFeed, parquet_sink
from tidemark.streaming.landing import LandedStream
from tidemark.streaming.offset_log import OffsetLog

_FAMILIES = ("double", "date", "string", "ts", "ties", *DERIVED)


#: Spans of the long log.
_LONG = 1200


class SinkDown(RuntimeError):
    """The failure a replay recovers from."""


class Growing:
    """A table whose visible rows change between runs, and the feed that follows it."""

    def __init__(
        self,
        spark: SparkSession,
        df: DataFrame,
        field: str,
        rows_per_batch: int | None = None,
        **options: str,
    ) -> None:
        self._spark = spark
        self._df = df
        self._options = {"offset.field": field, **options}
        self._rows_per_batch = rows_per_batch
        self.offset = OffsetColumn.of(df.schema, field)
        self.folder = shared_folder(spark, "feed")
        self.visible: Column = F.lit(True)
        self.table = FrameTable(lambda: self._df.where(self.visible))

    def upto(self, end: str) -> Column:
        return self.offset.column() <= self.offset.literal(end)

    def feed(self) -> IncrementalFeed:
        """A feed as a new process would make it: all it knows is in the log."""
        return IncrementalFeed(
            self._spark, self.table, self._options, f"{self.folder}/log", self._rows_per_batch
        )

    def run(self, visible: Column, sink: Callable | None = None) -> None:
        self.visible = visible
        self.feed().run_available(sink or parquet_sink(f"{self.folder}/out"))

    def delivered(self) -> DataFrame:
        schema = f"{_ddl(self._df)}, batch_id int"
        return self._spark.read.schema(schema).parquet(f"{self.folder}/out")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def stages(df: DataFrame, offset: OffsetColumn) -> tuple[str, str]:
    """Offsets at three and seven tenths of the range."""
    whole = BatchRange(*fetch_bound(both_bounds(df, offset), offset), True)
    tenths = split_range(offset, whole, 10)
    return tenths[2].end, tenths[6].end


STAGES_SQL = (
    "WITH b AS (SELECT MIN(event_id) AS lo, MAX(event_id) AS hi FROM events), "
    "s AS (SELECT lo, hi, lo + (hi - lo) * 3 // 10 AS s3, lo + (hi - lo) * 7 // 10 AS s7 FROM b) "
)
BATCH_SQL = (
    "CASE WHEN event_id <= (SELECT s3 FROM s) THEN 0 "
    "WHEN event_id <= (SELECT s7 FROM s) THEN 1 ELSE 2 END AS batch_id"
)


def events_growing(spark: SparkSession, sf: str) -> tuple[Growing, str, str]:
    df = TRACKED["number"].frame(spark, sf)
    growing = Growing(spark, df, "event_id")
    return growing, *stages(df, growing.offset)


def _in_three(spark: SparkSession, sf: str) -> Growing:
    growing, s3, s7 = events_growing(spark, sf)
    for visible in (growing.upto(s3), growing.upto(s7), F.lit(True)):
        growing.run(visible)
    return growing


def _drain_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _in_three(spark, sf).delivered()


def _restart_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A feed stops after the first stage; another one takes up the rest."""
    growing, s3, _ = events_growing(spark, sf)
    growing.run(growing.upto(s3))
    growing.run(F.lit(True))
    return growing.delivered().drop("batch_id")


def _drain_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _in_three(spark, sf).delivered()
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


def _drain_family(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    table = halves(spark, sf, kind)
    growing = Growing(spark, table.df, table.offset.name)
    growing.run(growing.upto(table.lower.end))
    growing.run(F.lit(True))
    return growing.delivered()


def _drain_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """The whole file table in one batch, bounds from footers."""
    tracked = TRACKED["ties"]
    folder = shared_folder(spark, "feed")
    table = tracked.source(spark, sf)
    feed = IncrementalFeed(spark, table, {"offset.field": tracked.field}, f"{folder}/log")
    feed.run_available(parquet_sink(f"{folder}/out"))
    return spark.read.schema(table.schema).parquet(f"{folder}/out/batch_id=0")


def _drain_capped(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Batches of at most a fiftieth of the table: rows and offsets that came, and what broke the cap.

    A batch over the cap must be a single value, and two neighbours must not fit into half a batch.
    """
    df = TRACKED[kind].frame(spark, sf)
    field = TRACKED[kind].field
    cap = max(df.count() // 50, 1)
    growing = Growing(spark, df, field, rows_per_batch=cap)
    growing.run(F.lit(True))
    batches = growing.delivered().groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(field).alias("n_values")
    )
    over = F.col("n_rows") > cap
    return batches.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.count_if(over & (F.col("n_values") > 1)).alias("n_split_over"),
        (F.count(F.lit(1)) >= F.least(F.sum("n_values"), F.lit(25))).alias("many_batches"),
    )


@contextmanager
def clocks_of(spark: SparkSession, zone: str) -> Iterator[None]:
    """The session's time zone is ``zone`` for a while."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def zoned_events(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A copy of events whose time is an instant (wall-clock times of UTC), and the middle of its range
    as clocks in Tokyo tell it."""
    table = halves(spark, sf, "ts")
    path = shared_folder(spark, "instants")
    utc = spark.newSession()
    utc.conf.set("spark.sql.session.timeZone", "UTC")
    utc.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    rows = utc.read.parquet(f"{sf}/events.parquet")
    rows.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    there = table.offset.parse(table.lower.end) + timedelta(hours=9)
    return path, there.isoformat(sep=" ")


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as the wall-clock times of UTC that they were made of."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn("ts", F.timestamp_add("MICROSECOND", F.unix_micros("ts"), epoch))


def _start_from_param_zoned(spark: SparkSession, sf: str) -> DataFrame:
    """A start given in the session's zone, which is not UTC."""
    path, start = zoned_events(spark, sf)
    with clocks_of(spark, "Asia/Tokyo"):
        growing = Growing(spark, spark.read.parquet(path), "ts", **{"start.offset": start})
        growing.run(F.lit(True))
    return zoneless(growing.delivered().drop("batch_id"))


def _drain_instants(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = zoned_events(spark, sf)
    with clocks_of(spark, "Asia/Tokyo"):
        df = spark.read.parquet(path)
        growing = Growing(spark, df, "ts", rows_per_batch=max(df.count() // 5, 1))
        growing.run(F.lit(True))
    return zoneless(growing.delivered().drop("batch_id"))


def _offset_log_long(spark: SparkSession, sf: str) -> DataFrame:
    """More spans than a log keeps as loose files, planned over the table and told in full."""
    df = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(df)
    whole = BatchRange(*fetch_bound(both_bounds(df, offset), offset), True)
    log = OffsetLog(spark, f"{shared_folder(spark, 'feed')}/log", offset.name)
    log.gather_at = 400
    for i, part in enumerate(split_range(offset, whole, _LONG)):
        log.plan(i, Span(part.start, part.end))
        log.commit(i)
    return log.frame()


def _landed_polled(spark: SparkSession, sf: str) -> DataFrame:
    """A table pulled in the background on a trigger, while it grows twice; a stream of what landed."""
    df = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(df)
    s3, s7 = stages(df, offset)
    shown: list[Column] = [F.lit(False)]
    table = FrameTable(lambda: df.where(shown[0]))
    folder = shared_folder(spark, "landed")
    landed = LandedStream(spark, table, {"offset.field": "event_id"}, folder)
    landing = landed.start(seconds=0.2)
    try:
        for visible in (offset.column() <= offset.literal(s3), offset.column() <= offset.literal(s7), F.lit(True)):
            shown[0] = visible
            landing.poll()
            query = (
                landed.load()
                .writeStream.format("parquet")
                .option("checkpointLocation", f"{folder}/checkpoint")
                .trigger(availableNow=True)
                .start(f"{folder}/out")
            )
            query.awaitTermination()
    finally:
        landing.stop()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _start_from_param(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that starts at a given offset; on later runs only the log counts."""
    df = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(df)
    s3, s7 = stages(df, offset)
    growing = Growing(spark, df, "event_id", **{"start.offset": s3})
    growing.run(growing.upto(s7))
    growing.run(F.lit(True))
    return growing.delivered()


def _replay_uncommitted(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch is written but not committed; the table grows; it runs again as it was."""
    growing, s3, s7 = events_growing(spark, sf)
    write = parquet_sink(f"{growing.folder}/out")

    def breaks(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        raise SinkDown

    growing.run(growing.upto(s3))
    try:
        growing.run(growing.upto(s7), breaks)
    except SinkDown:
        pass
    growing.run(F.lit(True))
    return growing.delivered()


def _late_rows_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks up to the second stage show up after it was delivered: too late."""
    growing, _, s7 = events_growing(spark, sf)
    growing.run(growing.upto(s7) & (F.col("event_type") != "click"))
    growing.run(F.lit(True))
    return growing.delivered().drop("batch_id")


def _null_offsets_skipped(spark: SparkSession, sf: str) -> DataFrame:
    df = TRACKED["number"].frame(spark, sf)
    seq = F.when(F.col("event_type") != "error", F.col("event_id"))
    growing = Growing(spark, df.withColumn("seq", seq), "seq")
    growing.run(F.lit(True))
    return growing.delivered().drop("batch_id")


def _shrunk_table(spark: SparkSession, sf: str) -> DataFrame:
    """The table loses rows and gets them back: nothing is delivered twice."""
    growing, s3, s7 = events_growing(spark, sf)
    for visible in (growing.upto(s7), growing.upto(s3), growing.upto(s7), F.lit(True)):
        growing.run(visible)
    return growing.delivered()


def _no_new_data(spark: SparkSession, sf: str) -> DataFrame:
    """Batches and rows of each of three runs; nothing is new to the second, something to the third."""
    growing, s3, _ = events_growing(spark, sf)
    runs: list[tuple[int, int, int]] = []
    for i, visible in enumerate((growing.upto(s3), growing.upto(s3), F.lit(True))):
        rows: list[int] = []
        growing.run(visible, lambda batch, _, rows=rows: rows.append(batch.count()))
        runs.append((i, len(rows), sum(rows)))
    return spark.createDataFrame(runs, "run int, n_batches long, n_rows long")


def _offset_log(spark: SparkSession, sf: str) -> DataFrame:
    return _in_three(spark, sf).feed().log.frame()


def _offset_log_json(spark: SparkSession, sf: str) -> DataFrame:
    log = _in_three(spark, sf).feed().log.frame()
    text = offset_to_json(F.col("field"), F.col("start_offset"), F.col("end_offset"))
    return log.select("batch_id", text.alias("offset_json"))


def _landed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Batches land as Parquet, a file stream counts them by day and type as they come."""
    df = TRACKED["ts"].frame(spark, sf)
    offset = TRACKED["ts"].offset(df)
    _, s7 = stages(df, offset)
    folder = shared_folder(spark, "landed")
    shown = [offset.column() <= offset.literal(s7)]
    table = FrameTable(lambda: df.where(shown[0]))
    landed = LandedStream(spark, table, {"offset.field": "ts"}, folder)
    for visible in (shown[0], F.lit(True)):
        shown[0] = visible
        landed.land_available()
        counts = landed.load().groupBy(F.to_date("ts").alias("day"), "event_type").agg(
            F.count(F.lit(1)).alias("n_rows")
        )
        query = (
            counts.writeStream.outputMode("complete")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(lambda full, _: full.write.mode("overwrite").parquet(f"{folder}/counts"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    schema = "day date, event_type string, n_rows long"
    return spark.read.schema(schema).parquet(f"{folder}/counts")


QUERIES = {
    "drain_batches": _drain_batches,
    "drain_counts": _drain_counts,
    "drain_parquet": _drain_parquet,
    "drain_capped": partial(_drain_capped, kind="ties"),
    "drain_capped_number": partial(_drain_capped, kind="number"),
    "drain_capped_double": partial(_drain_capped, kind="double"),
    "drain_capped_decimal": partial(_drain_capped, kind="decimal"),
    "drain_capped_ts": partial(_drain_capped, kind="ts"),
    "drain_capped_string": partial(_drain_capped, kind="string"),
    "drain_instants": _drain_instants,
    "start_from_param_zoned": _start_from_param_zoned,
    "offset_log_long": _offset_log_long,
    "landed_polled": _landed_polled,
    "start_from_param": _start_from_param,
    "restart_resume": _restart_resume,
    "replay_uncommitted": _replay_uncommitted,
    "late_rows_skipped": _late_rows_skipped,
    "null_offsets_skipped": _null_offsets_skipped,
    "shrunk_table": _shrunk_table,
    "no_new_data": _no_new_data,
    "offset_log": _offset_log,
    "offset_log_json": _offset_log_json,
    "landed_stream": _landed_stream,
}

_LOG_SQL = (
    "SELECT CAST(0 AS BIGINT) AS batch_id, 'event_id' AS field, CAST(lo AS VARCHAR) AS start_offset, "
    "CAST(s3 AS VARCHAR) AS end_offset FROM s UNION ALL "
    "SELECT 1, 'event_id', CAST(s3 AS VARCHAR), CAST(s7 AS VARCHAR) FROM s UNION ALL "
    "SELECT 2, 'event_id', CAST(s7 AS VARCHAR), CAST(hi AS VARCHAR) FROM s"
)

SQL = {
    "drain_batches": f"{STAGES_SQL} SELECT *, {BATCH_SQL} FROM events",
    "drain_counts": f"{STAGES_SQL} SELECT {BATCH_SQL}, COUNT(*) AS n_rows FROM events GROUP BY 1",
    "drain_parquet": "SELECT * FROM lineitem",
    **{
        name: (
            f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT {TRACKED[kind].field}) AS n_values, "
            f"CAST(0 AS BIGINT) AS n_split_over, TRUE AS many_batches FROM {TRACKED[kind].sql_table}"
        )
        for name, kind in (
            ("drain_capped", "ties"),
            ("drain_capped_number", "number"),
            ("drain_capped_double", "double"),
            ("drain_capped_decimal", "decimal"),
            ("drain_capped_ts", "ts"),
            ("drain_capped_string", "string"),
        )
    },
    "drain_instants": "SELECT * FROM events",
    "start_from_param_zoned": (
        f"WITH {TRACKED['ts'].sql_bounds} SELECT * FROM events WHERE ts >= (SELECT mid FROM m)"
    ),
    "offset_log_long": (
        "WITH b AS (SELECT MIN(event_id) AS lo, MAX(event_id) AS hi FROM events), "
        f"c AS (SELECT DISTINCT lo + (hi - lo) * i // {_LONG} AS cut FROM b, range(1, {_LONG}) r(i) "
        f"WHERE lo + (hi - lo) * i // {_LONG} > lo AND lo + (hi - lo) * i // {_LONG} < hi "
        "UNION SELECT lo FROM b UNION SELECT hi FROM b), "
        "p AS (SELECT cut, LEAD(cut) OVER (ORDER BY cut) AS upto, "
        "row_number() OVER (ORDER BY cut) - 1 AS batch_id FROM c) "
        "SELECT CAST(batch_id AS BIGINT) AS batch_id, 'event_id' AS field, "
        "CAST(cut AS VARCHAR) AS start_offset, CAST(upto AS VARCHAR) AS end_offset "
        "FROM p WHERE upto IS NOT NULL"
    ),
    "landed_polled": "SELECT * FROM events",
    "start_from_param": (
        f"{STAGES_SQL} SELECT *, CASE WHEN event_id <= (SELECT s7 FROM s) THEN 0 ELSE 1 END "
        "AS batch_id FROM events WHERE event_id >= (SELECT s3 FROM s)"
    ),
    "restart_resume": "SELECT * FROM events",
    "replay_uncommitted": f"{STAGES_SQL} SELECT *, {BATCH_SQL} FROM events",
    "late_rows_skipped": (
        f"{STAGES_SQL} SELECT * FROM events WHERE event_type <> 'click' OR event_id > "
        "(SELECT MAX(event_id) FROM events, s WHERE event_id <= s7 AND event_type <> 'click')"
    ),
    "null_offsets_skipped": "SELECT *, event_id AS seq FROM events WHERE event_type <> 'error'",
    "shrunk_table": (
        f"{STAGES_SQL} SELECT *, CASE WHEN event_id <= (SELECT s7 FROM s) THEN 0 ELSE 1 END "
        "AS batch_id FROM events"
    ),
    "no_new_data": (
        f"{STAGES_SQL} SELECT 0 AS run, CAST(1 AS BIGINT) AS n_batches, COUNT(*) AS n_rows FROM events "
        "WHERE event_id <= (SELECT s3 FROM s) UNION ALL SELECT 1, 0, 0 UNION ALL "
        "SELECT 2, 1, COUNT(*) FROM events WHERE event_id > (SELECT s3 FROM s)"
    ),
    "offset_log": f"{STAGES_SQL} {_LOG_SQL}",
    "offset_log_json": (
        f"{STAGES_SQL} SELECT batch_id, "
        """'{"fieldsOffsets":{"fieldName":"' || field || '","range":{"start":"' || start_offset"""
        """ || '","end":"' || end_offset || '"}}}' AS offset_json """
        f"FROM ({_LOG_SQL}) l"
    ),
    "landed_stream": (
        "SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n_rows FROM events GROUP BY 1, 2"
    ),
}

for _family in _FAMILIES:
    _tracked = TRACKED[_family]
    QUERIES[f"drain_{_family}"] = partial(_drain_family, kind=_family)
    SQL[f"drain_{_family}"] = (
        f"WITH {_tracked.sql_bounds} SELECT *, "
        f"CASE WHEN {_tracked.field} <= (SELECT mid FROM m) THEN 0 ELSE 1 END AS batch_id "
        f"FROM {_tracked.sql_table}"
    )
