"""The streaming source under Structured Streaming: drain, compose, restart, replay."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catalog.feeds import clocks_of, zoned_events, zoneless
from catalog.tables import TRACKED, halves, n_files
from tidemark.plans.workspace import shared_folder
from tidemark.streaming.datasource import drain_stream, read_stream
from tidemark.streaming.offset_log import read_spans

_FAMILIES = ("number", "double", "string", "ts", "ties")


def _to_parquet(stream: DataFrame, folder: str) -> StreamingQuery:
    """Run what is available through Spark's exactly-once file sink."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return query


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    folder = shared_folder(spark, "stream")
    _to_parquet(stream, folder)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _whole(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    tracked = TRACKED[kind]
    return _drained(spark, read_stream(spark, f"{sf}/{tracked.table}.parquet", tracked.field))


def _from_param(spark: SparkSession, sf: str) -> DataFrame:
    table = halves(spark, sf, "ts")
    start = {"start.offset": table.lower.end}
    return _drained(spark, read_stream(spark, f"{sf}/events.parquet", "ts", **start))


def _from_param_zoned(spark: SparkSession, sf: str) -> DataFrame:
    """A start given in the session's zone, which is not UTC."""
    path, start = zoned_events(spark, sf)
    with clocks_of(spark, "Asia/Tokyo"):
        return zoneless(_drained(spark, read_stream(spark, path, "ts", **{"start.offset": start})))


def _instants(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = zoned_events(spark, sf)
    with clocks_of(spark, "Asia/Tokyo"):
        return zoneless(_drained(spark, read_stream(spark, path, "ts")))


def _derived(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """A whole table tracked by a column of a type that the given files lack."""
    path = shared_folder(spark, "table")
    TRACKED[kind].frame(spark, sf).write.parquet(path)
    return _drained(spark, read_stream(spark, path, TRACKED[kind].field))


def _stepped(spark: SparkSession, sf: str) -> DataFrame:
    """A backlog of several files in steps, by runs that each end after one; all rows, each once."""
    df = TRACKED["ties"].frame(spark, sf)
    folder = shared_folder(spark, "stepped")
    n = df.count()
    df.repartitionByRange(n_files(n, 6), "l_orderkey").write.option("parquet.block.size", 1 << 18).parquet(f"{folder}/table")
    rows = str(max(n // 4, 1))

    def start() -> StreamingQuery:
        stream = read_stream(spark, f"{folder}/table", "l_orderkey", rowsPerBatch=rows, stepping="true")
        return (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{folder}/out")
        )

    drain_stream(start)
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """A table in folders by month and by a negative number; their types are Spark's."""
    df = TRACKED["date"].frame(spark, sf)
    path = shared_folder(spark, "table")
    month, k = F.trunc("o_date", "year").alias("o_year"), (-(F.col("o_orderkey") % 2)).cast("int").alias("k")
    df.select("o_orderkey", "o_date", "o_totalprice", month, k).repartition("o_year", "k").write.partitionBy("o_year", "k").parquet(path)
    stream = read_stream(spark, path, "o_orderkey")
    rows = _drained(spark, stream)
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in stream.schema if f.name in ("o_year", "k"))
    return rows.withColumn("folder_types", F.lit(kinds))


def _nan(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets that are NaN are never delivered, and do not hide the others."""
    path = shared_folder(spark, "table")
    df = TRACKED["number"].frame(spark, sf)
    tracked = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("event_id").cast("double"))
    df.withColumn("tracked", tracked).write.parquet(path)
    return _drained(spark, read_stream(spark, path, "tracked"))


def _columns(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{sf}/lineitem.parquet"
    kept = {"columns": "l_orderkey,l_linenumber,l_quantity"}
    return _drained(spark, read_stream(spark, path, "l_orderkey", **kept))


def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and value per day and event type, kept up to date by a streaming aggregation."""
    folder = shared_folder(spark, "daily")
    totals = (
        read_stream(spark, f"{sf}/events.parquet", "ts", columns="ts,event_type,value")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            # Added up as decimals, so the order of addition does not show.
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
        )
    )
    query = (
        totals.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(lambda full, _: full.write.mode("overwrite").parquet(f"{folder}/totals"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(totals.schema).parquet(f"{folder}/totals")


class GrowingFolder:
    """A Parquet folder that a query follows while rows are added to it."""

    def __init__(self, spark: SparkSession, field: str) -> None:
        self._spark = spark
        self._field = field
        self.folder = shared_folder(spark, "growing")
        self.table = f"{self.folder}/table"

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.table)

    def stream(self) -> DataFrame:
        return read_stream(self._spark, self.table, self._field)

    def run(self) -> None:
        """One run of the query; the next one resumes from its checkpoint."""
        _to_parquet(self.stream(), self.folder)

    def delivered(self) -> DataFrame:
        return self._spark.read.schema(self.stream().schema).parquet(f"{self.folder}/out")


def _in_two(spark: SparkSession, sf: str, kind: str) -> GrowingFolder:
    table = halves(spark, sf, kind)
    growing = GrowingFolder(spark, table.offset.name)
    first = table.offset.column() <= table.offset.literal(table.lower.end)
    for rows in (table.df.where(first), table.df.where(~first)):
        growing.add(rows)
        growing.run()
    return growing


def _restart(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The query stops, the table grows, the query goes on: every row once."""
    return _in_two(spark, sf, kind).delivered()


def _checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    growing = _in_two(spark, sf, "number")
    return read_spans(spark, f"{growing.folder}/checkpoint/offsets")


def _late(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks of the first half are added after it was delivered: too late."""
    table = halves(spark, sf, "number")
    growing = GrowingFolder(spark, table.offset.name)
    early = table.offset.column() <= table.offset.literal(table.lower.end)
    first = early & (F.col("event_type") != "click")
    for rows in (table.df.where(first), table.df.where(~first)):
        growing.add(rows)
        growing.run()
    return growing.delivered()


def _nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = TRACKED["number"].frame(spark, sf)
    growing = GrowingFolder(spark, "seq")
    seq = F.when(F.col("event_type") != "error", F.col("event_id"))
    growing.add(df.withColumn("seq", seq))
    growing.run()
    return growing.delivered()


def _windowed(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts with a watermark: every hour as of its last change, the open ones included.

    In update mode each batch tells the hours it changed; the latest word on an hour counts.
    """
    table = halves(spark, sf, "ts")
    growing = GrowingFolder(spark, "ts")
    first = table.offset.column() <= table.offset.literal(table.lower.end)
    for rows in (table.df.where(first), table.df.where(~first)):
        growing.add(rows)
        hours = (
            growing.stream()
            .withColumn("ts", F.col("ts").cast("timestamp"))
            .withWatermark("ts", "0 seconds")
            .groupBy(F.window("ts", "1 hour"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "n_rows")
        )
        query = (
            hours.writeStream.outputMode("update")
            .option("checkpointLocation", f"{growing.folder}/checkpoint")
            .foreachBatch(
                lambda changed, batch_id: changed.write.mode("overwrite").parquet(
                    f"{growing.folder}/out/batch_id={batch_id}"
                )
            )
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    changes = spark.read.schema(T.StructType(hours.schema.fields).add("batch_id", T.IntegerType()))
    latest = F.max_by("n_rows", "batch_id").alias("n_rows")
    return changes.parquet(f"{growing.folder}/out").groupBy("hour").agg(latest)


def _replay(spark: SparkSession, sf: str) -> DataFrame:
    """A batch fails after its offsets were logged and the table grows: it runs again as it was."""
    table = halves(spark, sf, "number")
    growing = GrowingFolder(spark, table.offset.name)
    first = table.offset.column() <= table.offset.literal(table.lower.end)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{growing.folder}/out/batch_id={batch_id}")

    def breaks(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        raise RuntimeError("sink is down")

    def run(sink: Callable[[DataFrame, int], None]) -> None:
        query = (
            growing.stream()
            .writeStream.option("checkpointLocation", f"{growing.folder}/checkpoint")
            .foreachBatch(sink)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    growing.add(table.df.where(first))
    try:
        run(breaks)
    except StreamingQueryException:
        pass
    growing.add(table.df.where(~first))
    # One run repeats the logged batch, the next one takes what came since.
    run(write)
    run(write)
    schema = T.StructType(growing.stream().schema.fields).add("batch_id", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{growing.folder}/out")


QUERIES = {
    "stream_daily": stream_daily,
    "stream_windowed": _windowed,
    "stream_from_param": _from_param,
    "stream_from_param_zoned": _from_param_zoned,
    "stream_instants": _instants,
    "stream_decimal": partial(_derived, kind="decimal"),
    "stream_float": partial(_derived, kind="float"),
    "stream_int": partial(_derived, kind="int"),
    "stream_date": partial(_derived, kind="date"),
    "stream_stepped": _stepped,
    "stream_partitioned": _partitioned,
    "stream_nan": _nan,
    "stream_columns": _columns,
    "stream_restart": partial(_restart, kind="number"),
    "stream_restart_date": partial(_restart, kind="date"),
    "stream_restart_string": partial(_restart, kind="string"),
    "stream_checkpoint": _checkpoint,
    "stream_late_rows": _late,
    "stream_null_offsets": _nulls,
    "stream_replay": _replay,
}

_NUMBER_BOUNDS = f"WITH {TRACKED['number'].sql_bounds}"

SQL = {
    "stream_daily": (
        "SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n_rows, "
        "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value "
        "FROM events GROUP BY 1, 2"
    ),
    "stream_windowed": (
        "SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS n_rows FROM events GROUP BY 1"
    ),
    "stream_from_param": (
        f"WITH {TRACKED['ts'].sql_bounds} SELECT * FROM events WHERE ts >= (SELECT mid FROM m)"
    ),
    "stream_from_param_zoned": (
        f"WITH {TRACKED['ts'].sql_bounds} SELECT * FROM events WHERE ts >= (SELECT mid FROM m)"
    ),
    "stream_instants": "SELECT * FROM events",
    **{f"stream_{kind}": f"SELECT * FROM {TRACKED[kind].sql_table}" for kind in ("decimal", "float", "int", "date")},
    "stream_stepped": "SELECT * FROM lineitem",
    "stream_partitioned": (
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date, o_totalprice, "
        "CAST(date_trunc('year', o_orderdate) AS DATE) AS o_year, CAST(-(o_orderkey % 2) AS INTEGER) AS k, "
        "'o_year:date,k:int' AS folder_types FROM orders"
    ),
    "stream_nan": (
        "SELECT *, CAST(event_id AS DOUBLE) AS tracked FROM events WHERE event_type <> 'error'"
    ),
    "stream_columns": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "stream_restart": "SELECT * FROM events",
    "stream_restart_date": "SELECT *, CAST(o_orderdate AS DATE) AS o_date FROM orders",
    "stream_restart_string": "SELECT * FROM customer",
    "stream_checkpoint": (
        f"{_NUMBER_BOUNDS} SELECT CAST(0 AS BIGINT) AS batch_id, 'event_id' AS field, "
        "CAST(lo AS VARCHAR) AS start_offset, CAST(mid AS VARCHAR) AS end_offset FROM m "
        "UNION ALL SELECT 1, 'event_id', CAST(mid AS VARCHAR), CAST(hi AS VARCHAR) FROM m"
    ),
    "stream_late_rows": (
        f"{_NUMBER_BOUNDS} SELECT * FROM events WHERE event_type <> 'click' OR event_id > "
        "(SELECT MAX(event_id) FROM events, m WHERE event_id <= mid AND event_type <> 'click')"
    ),
    "stream_null_offsets": "SELECT *, event_id AS seq FROM events WHERE event_type <> 'error'",
    "stream_replay": (
        f"{_NUMBER_BOUNDS} SELECT *, CASE WHEN event_id <= (SELECT mid FROM m) THEN 0 ELSE 1 END "
        "AS batch_id FROM events"
    ),
}

for _family in _FAMILIES:
    QUERIES[f"stream_{_family}"] = partial(_whole, kind=_family)
    SQL[f"stream_{_family}"] = f"SELECT * FROM {TRACKED[_family].table}"
