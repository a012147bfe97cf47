"""Times the headline operations; prints one JSON line.

Each is run once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.streams import stream_daily  # noqa: E402
from tidemark.functions.offset_column import OffsetColumn  # noqa: E402
from tidemark.operators.batch_cuts import batch_ends  # noqa: E402
from tidemark.operators.profile import offset_profile  # noqa: E402
from tidemark.operators.ranges import BatchRange, split_range  # noqa: E402
from tidemark.plans.workspace import shared_folder  # noqa: E402
from tidemark.sources.tables import ParquetTable  # noqa: E402
from tidemark.streaming.datasource import read_stream  # noqa: E402
from tidemark.streaming.feed import IncrementalFeed, parquet_sink  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict[str, Callable[[], object]]:
    events = ParquetTable(spark, f"{SF}/events.parquet")
    lineitem = ParquetTable(spark, f"{SF}/lineitem.parquet")
    event_id = OffsetColumn.of(events.schema, "event_id")
    ts = OffsetColumn.of(events.schema, "ts")
    key = OffsetColumn.of(lineitem.schema, "l_orderkey")
    whole = BatchRange(*lineitem.bounds(key), True)
    lower, upper = split_range(key, whole, 2)
    rows = lineitem.frame().count()

    # The same rows as one file per core: the given file is a single row group.
    parts = shared_folder(spark, "parts")
    lineitem.frame().repartitionByRange(int(CPUS), "l_orderkey").write.parquet(parts)
    split = ParquetTable(spark, parts)

    # And so that every file spans the whole range.
    mixed = shared_folder(spark, "mixed")
    lineitem.frame().repartition(int(CPUS)).write.parquet(mixed)
    scattered = ParquetTable(spark, mixed)
    price = OffsetColumn.of(lineitem.schema, "l_extendedprice")
    indexed = ParquetTable(spark, mixed, index=shared_folder(spark, "index"))

    def feed(table: ParquetTable, field: str, rows_per_batch: int | None = None, one_pass: bool | None = None):
        folder = shared_folder(spark, "feed")
        options = {"offset.field": field}
        log = f"{folder}/log"
        return IncrementalFeed(spark, table, options, log, rows_per_batch, one_pass=one_pass), f"{folder}/out"

    def drain(table: ParquetTable, field: str, rows_per_batch: int | None = None, one_pass: bool | None = None) -> None:
        runner, out = feed(table, field, rows_per_batch, one_pass)
        runner.run_available(parquet_sink(out))

    idle, idle_out = feed(events, "event_id")
    idle.run_available(parquet_sink(idle_out))

    def stream(path: str, field: str) -> None:
        drain_noop(read_stream(spark, path, field))

    def native_stream(path: str) -> None:
        drain_noop(spark.readStream.schema(lineitem.schema).parquet(path))

    def drain_noop(rows: DataFrame) -> None:
        query = (
            rows.writeStream.format("noop")
            .option("checkpointLocation", shared_folder(spark, "stream"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    return {
        "probe_number": lambda: events.bounds(event_id),
        "probe_number_from": lambda: events.bounds(event_id, "1"),
        "probe_ts": lambda: events.bounds(ts),
        "range_lower": lambda: discard(lineitem.read(key, lower)),
        "range_upper": lambda: discard(lineitem.read(key, upper)),
        "range_split_files": lambda: discard(split.read(key, whole)),
        "native_read": lambda: discard(lineitem.frame()),
        "drain_one_batch": lambda: drain(lineitem, "l_orderkey"),
        "drain_one_batch_split_files": lambda: drain(split, "l_orderkey"),
        "drain_ten_batches": lambda: drain(split, "l_orderkey", rows // 10),
        "drain_thirty_scattered": lambda: drain(scattered, "l_orderkey", rows // 30, False),
        "drain_thirty_scattered_one_pass": lambda: drain(scattered, "l_orderkey", rows // 30, True),
        "probe_double": lambda: scattered.bounds(price),
        "probe_double_indexed": lambda: indexed.bounds(price),
        "plan_ten_batches": lambda: batch_ends(partial(split.read, key), key, whole, rows // 10),
        "plan_thousand_batches": lambda: batch_ends(partial(split.read, key), key, whole, rows // 1000),
        "native_write_split_files": lambda: split.frame().write.parquet(shared_folder(spark, "native")),
        "no_new_data": lambda: idle.run_available(parquet_sink(idle_out)),
        "offset_profile": lambda: offset_profile(lineitem.frame(), "l_orderkey").collect(),
        "stream_events": lambda: stream(f"{SF}/events.parquet", "event_id"),
        "stream_lineitem": lambda: stream(f"{SF}/lineitem.parquet", "l_orderkey"),
        "stream_lineitem_split_files": lambda: stream(parts, "l_orderkey"),
        "native_stream_split_files": lambda: native_stream(parts),
        "stream_daily": lambda: stream_daily(spark, SF).collect(),
    }


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    seconds = {}
    for name, run in cases(spark).items():
        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 4)
    spark.stop()
    result = {
        "metric": "incremental_read_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
