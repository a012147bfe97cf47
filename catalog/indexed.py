"""Tables that keep the bounds of their files, backlogs cut in one pass, and commits that name their output."""

from __future__ import annotations

import json
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.feeds import BATCH_SQL, STAGES_SQL, events_growing, stages
from catalog.tables import TRACKED, n_files
from tidemark.functions.offset_column import OffsetColumn
from tidemark.functions.offset_json import offset_dict
from tidemark.operators.profile import offset_order_profile
from tidemark.operators.ranges import BatchRange
from tidemark.plans.workspace import shared_folder
from tidemark.sources.bounds_index import BoundsIndex
from tidemark.sources.tables import FrameTable, ParquetTable
from tidemark.streaming.agreement import HadoopStore
from tidemark.streaming.datasource import read_stream
from tidemark.streaming.feed import IncrementalFeed
from tidemark.streaming.sinks import committed_sink, late_rows, parquet_sink, read_committed

#: ``events.value`` as a column with NULLs and NaNs.
_MEASURED = "CASE event_type WHEN 'error' THEN double('NaN') WHEN 'click' THEN NULL ELSE value END"


#: Offset, and when rows were published, in Spark and in SQL: by key, in lots of keys, by user.
_ORDERS = {
    "by_key": ("ts", "event_id", "event_id"),
    "by_lots": ("ts", "event_id div 64", "(event_id // 64)"),
    "by_user": ("event_id", "user_id", "user_id"),
    "in_order": ("event_id", "event_id div 10", "(event_id // 10)"),
}


class Grown(NamedTuple):
    """A copy of a given table that grows by whole files."""

    rows: DataFrame
    folder: str

    @property
    def path(self) -> str:
        return f"{self.folder}/table"

    @property
    def index(self) -> str:
        return f"{self.folder}/index"

    def add(self, some: Column) -> None:
        self.rows.where(some).write.mode("append").parquet(self.path)


def _grown(spark: SparkSession, rows: DataFrame) -> Grown:
    return Grown(rows, shared_folder(spark, "indexed"))


def _indexed(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Bounds and counts from an index that was kept over two growths; files of the first are read once."""
    if kind == "measured":
        rows, field = TRACKED["number"].frame(spark, sf).withColumn("measured", F.expr(_MEASURED)), "measured"
    else:
        rows, field = TRACKED[kind].frame(spark, sf), TRACKED[kind].field
    table = _grown(spark, rows)
    offset = OffsetColumn.of(rows.schema, field)
    first = F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == 0
    table.add(first)
    index = BoundsIndex(spark, table.path, table.index, offset, rows.schema)
    before = index.refresh()
    table.add(~first)
    after = index.refresh()
    told = index.summary()
    return told.select(
        "n_rows", "n_nulls", "n_nans", "start_offset", "end_offset",
        (F.lit(before + after) == F.col("n_files")).alias("read_once"),
    )


def _drain_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Three growths by files, each followed by a run that opens only what is new."""
    rows = TRACKED["number"].frame(spark, sf)
    table = _grown(spark, rows)
    offset = TRACKED["number"].offset(rows)
    s3, s7 = (offset.literal(s) for s in stages(rows, offset))
    c = offset.column()
    for some in (c <= s3, (c > s3) & (c <= s7), c > s7):
        table.add(some)
        feed = IncrementalFeed(
            spark, ParquetTable(spark, table.path, index=table.index), {"offset.field": offset.name}, f"{table.folder}/log"
        )
        feed.run_available(parquet_sink(f"{table.folder}/out"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", batch_id int"
    return spark.read.schema(schema).parquet(f"{table.folder}/out")


def _stream_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The stream source planned from an index, over a table that grows between its runs."""
    rows = TRACKED["ties"].frame(spark, sf)
    table = _grown(spark, rows)
    offset = TRACKED["ties"].offset(rows)
    _, s7 = stages(rows, offset)
    for some in (offset.column() <= offset.literal(s7), offset.column() > offset.literal(s7)):
        table.add(some)
        query = (
            read_stream(spark, table.path, offset.name, index=table.index)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{table.folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{table.folder}/out")
        )
        query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{table.folder}/out")


class _Counting(FrameTable):
    """A table that counts how often a range of it is read."""

    def __init__(self, load) -> None:
        super().__init__(load)
        self.n_reads = 0

    def pinned(self) -> _Counting:
        return self

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        self.n_reads += 1
        return super().read(offset, batch)


def _scattered(spark: SparkSession, sf: str, kind: str) -> tuple[Grown, IncrementalFeed, _Counting]:
    """A copy whose every file spans the whole range, drained in some twenty batches and one pass."""
    rows = TRACKED[kind].frame(spark, sf)
    copy = _grown(spark, rows)
    n = rows.count()
    rows.repartition(n_files(n, 8), F.xxhash64(*rows.columns)).write.parquet(copy.path)
    table = _Counting(lambda: spark.read.schema(rows.schema).parquet(copy.path))
    cap = max(n // 20, 1)
    feed = IncrementalFeed(
        spark, table, {"offset.field": TRACKED[kind].field}, f"{copy.folder}/log", rows_per_batch=cap, one_pass=True
    )
    feed.run_available(committed_sink(f"{copy.folder}/out"))
    return copy, feed, table


def _drain_unclustered(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    copy, feed, _ = _scattered(spark, sf, kind)
    return read_committed(spark, f"{copy.folder}/out", feed.log, copy.rows.schema).drop("batch_id")


def _drain_unclustered_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and offsets that came, batches over the cap that hold several values, and reads of the table: one to
    plan (more where values crowd), one to deliver."""
    copy, feed, table = _scattered(spark, sf, "ties")
    field = TRACKED["ties"].field
    cap = max(copy.rows.count() // 20, 1)
    out = read_committed(spark, f"{copy.folder}/out", feed.log, copy.rows.schema)
    batches = out.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(field).alias("n_values"))
    return batches.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.count_if((F.col("n_rows") > cap) & (F.col("n_values") > 1)).alias("n_split_over"),
        F.lit(table.n_reads).cast("long").alias("n_reads"),
    )


#: Customers with a name that many share, in two spellings.
_SPELLED = "(CASE WHEN c_custkey % 2 = 0 THEN 'Key-' ELSE 'kEY-' END) || CAST(c_custkey % 40 AS STRING)"


def _drain_capped_collated(spark: SparkSession, sf: str) -> DataFrame:
    """Batches in the order of a collation: rows and values that came (one in two batches counts twice), and what broke the cap."""
    rows = spark.read.parquet(f"{sf}/customer.parquet").withColumn("spelled", F.expr(f"collate({_SPELLED}, 'UTF8_LCASE')"))
    cap = max(rows.count() // 9, 1)
    folder = shared_folder(spark, "collated")
    feed = IncrementalFeed(spark, FrameTable(lambda: rows), {"offset.field": "spelled"}, f"{folder}/log", rows_per_batch=cap)
    feed.run_available(parquet_sink(f"{folder}/out"))
    out = spark.read.schema("c_custkey long, spelled string, batch_id int").parquet(f"{folder}/out").withColumn("value", F.lower("spelled"))
    batches = out.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("value").alias("n_values"))
    return batches.agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.count_if((F.col("n_rows") > cap) & (F.col("n_values") > 1)).alias("n_split_over"),
        (F.count(F.lit(1)) >= F.least(F.sum("n_values"), F.lit(5))).alias("many_batches"),
    )


def _drain_committed(spark: SparkSession, sf: str) -> DataFrame:
    """Three growths; before the second is delivered, an attempt that never commits writes other rows for it."""
    growing, s3, s7 = events_growing(spark, sf)
    sink = committed_sink(f"{growing.folder}/committed")
    rows = TRACKED["number"].frame(spark, sf)
    for i, visible in enumerate((growing.upto(s3), growing.upto(s7), F.lit(True))):
        if i == 1:
            sink.write(rows, i, 0)
        growing.run(visible, sink)
    return read_committed(spark, f"{growing.folder}/committed", growing.feed().log, rows.schema)


def _drain_agreed(spark: SparkSession, sf: str) -> DataFrame:
    """Three growths by a log that renames nothing; between them a runner dies with a span begun but not decided, and with
    one that is decided but not written down."""
    growing, s3, s7 = events_growing(spark, sf)
    rows, folder = TRACKED["number"].frame(spark, sf), growing.folder
    sink = committed_sink(f"{folder}/agreed")

    def feed(visible) -> IncrementalFeed:
        table = FrameTable(lambda: rows.where(visible))
        return IncrementalFeed(spark, table, {"offset.field": growing.offset.name}, f"{folder}/agreed-log", agreed=True)

    for i, visible in enumerate((growing.upto(s3), growing.upto(s7), F.lit(True))):
        runner = feed(visible)
        runner.run_available(sink)
        store = HadoopStore(spark, f"{folder}/agreed-log")
        if i == 0:
            store.put(f"claims/offsets/{i + 1}/00000007.dead.1", "")
        elif i == 1:
            top = rows.agg(F.max(growing.offset.name)).first()[0]
            span = offset_dict(growing.offset.name, runner.last_offset.end, growing.offset.format(top))
            value = {"writer": "dead", "files": {"offsets": json.dumps(span)}}
            store.put(f"claims/offsets/{i + 1}/00000003.dead.2", json.dumps(value))
    return read_committed(spark, f"{folder}/agreed", runner.log, rows.schema)


def _late_rows_found(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks up to the second stage show up after it was delivered: the span they belong to is told."""
    growing, _, s7 = events_growing(spark, sf)
    sink = committed_sink(f"{growing.folder}/committed")
    growing.run(growing.upto(s7) & (F.col("event_type") != "click"), sink)
    growing.run(F.lit(True), sink)
    return late_rows(growing.table.frame(), growing.offset, growing.feed().log)


def _schema_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """A table that lacks a column and has a narrower one at first; the log takes up what it becomes."""
    rows = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(rows)
    s3, _ = stages(rows, offset)
    folder = shared_folder(spark, "evolved")
    early = rows.where(offset.column() <= offset.literal(s3)).withColumn("user_id", F.col("user_id").cast("int")).drop("value")
    for frame in (early, rows):
        feed = IncrementalFeed(spark, FrameTable(lambda frame=frame: frame), {"offset.field": offset.name}, f"{folder}/log")
        feed.run_available(committed_sink(f"{folder}/out"))
    return read_committed(spark, f"{folder}/out", feed.log, rows.schema)


def _offset_order(spark: SparkSession, sf: str, field: str, published: str) -> DataFrame:
    return offset_order_profile(TRACKED["number"].frame(spark, sf), field, F.expr(published))


QUERIES = {
    **{f"index_{kind}": partial(_indexed, kind=kind) for kind in ("number", "double", "string", "ts", "decimal", "measured")},
    "drain_indexed": _drain_indexed,
    "stream_indexed": _stream_indexed,
    **{f"drain_unclustered_{kind}": partial(_drain_unclustered, kind=kind) for kind in ("number", "double", "ts", "ties")},
    "drain_unclustered_cap": _drain_unclustered_cap,
    "drain_capped_collated": _drain_capped_collated,
    "drain_committed": _drain_committed,
    "drain_agreed": _drain_agreed,
    "late_rows_found": _late_rows_found,
    "schema_evolved": _schema_evolved,
    **{f"offset_order_{name}": partial(_offset_order, field=field, published=by) for name, (field, by, _) in _ORDERS.items()},
}


def _counts(field: str, table: str) -> str:
    return (
        f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, COUNT(*) - COUNT({field}) AS n_nulls, CAST(0 AS BIGINT) AS n_nans, "
        f"MIN({field}) AS start_offset, MAX({field}) AS end_offset, TRUE AS read_once FROM {table}"
    )


SQL = {
    **{f"index_{kind}": _counts(TRACKED[kind].field, TRACKED[kind].sql_table) for kind in ("number", "double", "string", "ts", "decimal")},
    "index_measured": (
        "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, COUNT(*) FILTER (event_type = 'click' OR (event_type <> 'error' AND value IS NULL)) AS n_nulls, "
        "COUNT(*) FILTER (event_type = 'error') AS n_nans, MIN(value) FILTER (event_type NOT IN ('click', 'error')) AS start_offset, "
        "MAX(value) FILTER (event_type NOT IN ('click', 'error')) AS end_offset, TRUE AS read_once FROM events"
    ),
    "drain_indexed": f"{STAGES_SQL} SELECT *, {BATCH_SQL} FROM events",
    "stream_indexed": "SELECT * FROM lineitem",
    **{f"drain_unclustered_{kind}": f"SELECT * FROM {TRACKED[kind].sql_table}" for kind in ("number", "double", "ts", "ties")},
    "drain_unclustered_cap": (
        "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_values, CAST(0 AS BIGINT) AS n_split_over, "
        "CAST(2 AS BIGINT) AS n_reads FROM lineitem"
    ),
    "drain_capped_collated": (
        f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT lower({_SPELLED})) AS n_values, CAST(0 AS BIGINT) AS n_split_over, "
        "TRUE AS many_batches FROM customer"
    ),
    "drain_committed": f"{STAGES_SQL} SELECT *, {BATCH_SQL} FROM events",
    "drain_agreed": f"{STAGES_SQL} SELECT *, {BATCH_SQL} FROM events",
    "late_rows_found": (
        f"{STAGES_SQL}, d AS (SELECT MIN(event_id) AS lo, MAX(event_id) AS hi, COUNT(*) AS n FROM events "
        "WHERE event_id <= (SELECT s7 FROM s) AND event_type <> 'click'), "
        "n AS (SELECT COUNT(*) AS n FROM events, d WHERE event_id BETWEEN lo AND hi) "
        "SELECT CAST(0 AS BIGINT) AS batch_id, CAST(lo AS VARCHAR) AS start_offset, CAST(hi AS VARCHAR) AS end_offset, "
        "d.n AS rows_then, n.n AS rows_now FROM d, n WHERE d.n <> n.n"
    ),
    "schema_evolved": (
        f"{STAGES_SQL} SELECT * REPLACE (CASE WHEN event_id > (SELECT s3 FROM s) THEN value END AS value), "
        "CASE WHEN event_id <= (SELECT s3 FROM s) THEN 0 ELSE 1 END AS batch_id FROM events"
    ),
    **{
        f"offset_order_{name}": (
            f"WITH g AS (SELECT {by} AS pub, MAX({field}) AS most FROM events GROUP BY 1), "
            "p AS (SELECT pub, MAX(most) OVER (ORDER BY pub ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS passed FROM g), "
            f"l AS (SELECT pub, COUNT(*) AS n, COUNT(*) FILTER ({field} < passed) AS below FROM events JOIN p ON {by} = pub "
            f"WHERE {field} <= passed GROUP BY pub) "
            f"SELECT '{field}' AS field, (SELECT COUNT({field}) FROM events) AS n_rows, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_late, "
            "CAST(COALESCE(SUM(below), 0) AS BIGINT) AS n_below, COUNT(*) AS n_publications FROM l"
        )
        for name, (field, _, by) in _ORDERS.items()
    },
}
