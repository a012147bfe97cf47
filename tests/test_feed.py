import os
import time
from bisect import bisect_left
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import days
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.bounds import both_bounds, fetch_bound
from tidemark.operators.ranges import BatchRange
from tidemark.plans.progress import Span
from tidemark.sources.tables import FrameTable, ParquetTable
from tidemark.streaming.feed import IncrementalFeed, parquet_sink
from tidemark.streaming.landing import LandedStream
from tidemark.streaming.lease import LeaseTaken

SCHEMA = "a int, b long, c double, d date, e string, t timestamp_ntz"


def rows_for(values, field):
    """Rows that differ in ``field``; the other columns are constant."""
    base = {
        "a": 1,
        "b": 2,
        "c": 3.0,
        "d": date(2020, 1, 1),
        "e": "x",
        "t": datetime(2020, 1, 1),
    }
    return [tuple({**base, field: v}.values()) for v in values]


class Bench:
    """A table held as a list of rows, the feed that follows it, and what it delivered."""

    def __init__(self, spark, folder, field, **kwargs):
        self.spark, self.folder, self.field = spark, folder, field
        self.options = {"offset.field": field, **kwargs.pop("options", {})}
        self.kwargs = kwargs
        self.rows = []
        self.got = {}

    def feed(self):
        table = FrameTable(lambda: self.spark.createDataFrame(self.rows, SCHEMA))
        return IncrementalFeed(
            self.spark, table, self.options, f"{self.folder}/log", **self.kwargs
        )

    def sink(self, batch, batch_id):
        self.got[batch_id] = sorted(r[self.field] for r in batch.collect())

    def run(self, values=None, sink=None):
        if values is not None:
            self.rows = rows_for(values, self.field)
        return self.feed().run_available(sink or self.sink)


@pytest.mark.parametrize(
    "field, steps, spans",
    [
        (
            "d",
            [days("2020-01-01", "2020-01-03"), days("2020-01-04", "2020-01-08"),
             days("2020-01-09", "2020-01-15"), days("2020-01-16", "2020-01-20")],
            ["2020-01-01", "2020-01-03", "2020-01-08", "2020-01-15", "2020-01-20"],
        ),
        (
            "a",
            [range(1, 4), range(4, 9), range(9, 16), range(16, 21)],
            ["1", "3", "8", "15", "20"],
        ),
        (
            "c",
            [[0.5, 1.0, 1.5, 2.0], [2.5, 3.0, 3.5, 4.0, 4.5], [5.0, 9.5], [10.0, 12.5]],
            ["0.5", "2.0", "4.5", "9.5", "12.5"],
        ),
        ("e", [["a", "b'"], ["c", "cc"], ["d"]], ["a", "b'", "cc", "d"]),
        (
            "t",
            [
                [datetime(2020, 1, 1, 5), datetime(2020, 1, 1, 6, 0, 0, 1)],
                [datetime(2020, 1, 1, 6, 0, 0, 2), datetime(2020, 1, 1, 7)],
            ],
            ["2020-01-01 05:00:00", "2020-01-01 06:00:00.000001", "2020-01-01 07:00:00"],
        ),
    ],
    ids=["date", "int", "double", "string", "timestamp"],
)
def test_batches_follow_a_growing_table(spark, folder, field, steps, spans):
    bench = Bench(spark, folder, field)
    seen = []
    for i, step in enumerate(steps):
        seen += list(step)
        (done,) = bench.run(seen)
        assert done.batch_id == i
        assert done.batch == BatchRange(spans[i], spans[i + 1], inclusive=i == 0)
        assert bench.got[i] == sorted(step)
        assert bench.feed().last_offset == Span(spans[i], spans[i + 1])


def test_overwritten_table_that_moved_on(spark, folder):
    """The table is replaced by later rows; the row at the old end is not delivered again."""
    bench = Bench(spark, folder, "d")
    bench.run(days("2020-01-01", "2020-01-05"))
    (done,) = bench.run(days("2020-01-05", "2020-01-10"))
    assert done.batch == BatchRange("2020-01-05", "2020-01-10")
    assert bench.got[1] == days("2020-01-06", "2020-01-10")


def test_nothing_new_nothing_delivered(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 2, 3])
    assert [bench.run() for _ in range(3)] == [[], [], []]
    assert len(bench.run([1, 2, 3, 4])) == 1
    assert bench.got[1] == [4]


@pytest.mark.parametrize("values", [[], [None, None]])
def test_a_table_without_offsets_waits(spark, folder, values):
    bench = Bench(spark, folder, "a")
    assert bench.run(values) == [] and bench.feed().last_offset is None
    assert len(bench.run([*values, 7])) == 1
    assert bench.got == {0: [7]}


def test_null_offsets_are_never_delivered(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, None, 2])
    bench.run([1, None, 2, None, 3])
    assert bench.got == {0: [1, 2], 1: [3]}


def test_nan_offsets_are_never_delivered_and_hide_nothing(spark, folder):
    bench = Bench(spark, folder, "c")
    bench.run([1.0, float("nan"), 2.0])
    bench.run([1.0, float("nan"), 2.0, 3.0])
    assert bench.got == {0: [1.0, 2.0], 1: [3.0]}


def test_late_rows_are_never_delivered(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 5, 9])
    bench.run([1, 5, 9, 4, 9, 10])
    assert bench.got == {0: [1, 5, 9], 1: [10]}


def test_ties_at_the_end_arrive_together(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 5, 5, 5])
    assert bench.got == {0: [1, 5, 5, 5]}


def test_a_shrunk_table_delivers_nothing_twice(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 2, 3, 4, 5])
    assert bench.run([1, 2]) == []
    assert bench.run([1, 2, 3, 4, 5]) == []
    bench.run([1, 2, 3, 4, 5, 6])
    assert bench.got == {0: [1, 2, 3, 4, 5], 1: [6]}


def test_start_offset_from_options_is_used_as_given(spark, folder):
    bench = Bench(spark, folder, "d", options={"start.offset": "2020-01-03"})
    (done,) = bench.run(days("2020-01-01", "2020-01-05"))
    assert done.batch == BatchRange("2020-01-03", "2020-01-05", inclusive=True)
    assert bench.got[0] == days("2020-01-03", "2020-01-05")


def test_start_offset_between_values_is_not_moved_to_one(spark, folder):
    bench = Bench(spark, folder, "c", options={"start.offset": "1.75"})
    (done,) = bench.run([1.0, 2.0])
    assert done.batch.start == "1.75" and bench.got[0] == [2.0]


def test_start_offset_beyond_the_data_waits(spark, folder):
    bench = Bench(spark, folder, "a", options={"start.offset": "10"})
    assert bench.run([1, 2, 3]) == []
    bench.run([1, 2, 3, 9, 10, 11])
    assert bench.got == {0: [10, 11]}


def test_start_offset_is_ignored_after_a_restart(spark, folder):
    bench = Bench(spark, folder, "a", options={"start.offset": "2"})
    bench.run([1, 2, 3])
    bench.options["start.offset"] = "1"
    bench.run([1, 2, 3, 4])
    assert bench.got == {0: [2, 3], 1: [4]}


def test_timestamps_of_one_day_and_of_the_last_day_are_delivered(spark, folder):
    """Bounds keep the time of day: nothing waits for a later day."""
    bench = Bench(spark, folder, "t")
    values = [datetime(2020, 1, 1, 8), datetime(2020, 1, 1, 23, 59, 59, 999999)]
    bench.run(values)
    assert bench.got == {0: values}


def test_an_uncommitted_batch_runs_again_with_its_bounds(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 2])

    def breaks(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError, match="sink is down"):
        bench.run([1, 2, 3, 4], breaks)
    done = bench.run([1, 2, 3, 4, 5, 6])
    assert [d.batch for d in done] == [BatchRange("2", "4"), BatchRange("4", "6")]
    assert bench.got == {0: [1, 2], 1: [3, 4], 2: [5, 6]}


def test_an_uncommitted_first_batch_stays_inclusive(spark, folder):
    bench = Bench(spark, folder, "a")

    def breaks(batch, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError, match="sink is down"):
        bench.run([1, 2], breaks)
    bench.run([1, 2, 3])
    assert bench.got == {0: [1, 2], 1: [3]}


def test_repeating_into_the_parquet_sink_counts_once(spark, folder):
    bench = Bench(spark, folder, "a")
    write = parquet_sink(f"{folder}/out")

    def breaks(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("died before the commit")

    with pytest.raises(RuntimeError):
        bench.run([1, 2, 3], breaks)
    bench.run([1, 2, 3, 4], write)
    rows = spark.read.parquet(f"{folder}/out").select("batch_id", "a").collect()
    assert sorted(map(tuple, rows)) == [(0, 1), (0, 2), (0, 3), (1, 4)]


def test_two_writers_on_one_log_collide(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 2])
    bench.rows = rows_for([1, 2, 3], "a")

    def overtaken(batch, batch_id):
        bench.feed().log.commit(batch_id)

    with pytest.raises(RuntimeError, match="another writer"):
        bench.feed().run_available(overtaken)


def test_log_of_another_column_is_refused(spark, folder):
    bench = Bench(spark, folder, "a")
    bench.run([1, 2])
    bench.options = {"offset.field": "b"}
    with pytest.raises(ValueError, match="tracks 'a'"):
        bench.run()


def test_old_log_entries_are_kept_and_gathered(spark, folder):
    bench = Bench(spark, folder, "a")
    for last in range(1, 9):
        bench.run(list(range(1, last + 1)))
        if last == 5:
            log = bench.feed().log
            log.leave = 1
            log.gather()
    log = bench.feed().log
    assert [tuple(r) for r in log.frame().orderBy("batch_id").collect()] == [
        (0, "a", "1", "1"),
        *((i, "a", str(i), str(i + 1)) for i in range(1, 8)),
    ]
    assert sorted(log._ids("offsets")) == [4, 5, 6, 7]
    bench.run(list(range(1, 10)))
    assert bench.got[8] == [9]


def test_a_second_runner_is_refused_before_it_delivers(spark, folder):
    bench = Bench(spark, folder, "a")
    delivered = []

    def sink(batch, batch_id):
        bench.sink(batch, batch_id)
        with pytest.raises(LeaseTaken):
            bench.run(sink=lambda *_: delivered.append(1))

    bench.run([1, 2], sink)
    assert delivered == [] and bench.got == {0: [1, 2]}
    bench.run([1, 2, 3])
    assert bench.got[1] == [3]


def test_the_lease_of_a_dead_runner_expires_and_stops_it_should_it_wake(spark, folder):
    bench = Bench(spark, folder, "a", lease_seconds=2.0)
    dead = bench.feed()._lease
    dead.__enter__()
    dead._stop.set()
    with pytest.raises(LeaseTaken):
        bench.run([1])
    time.sleep(2.2)
    bench.run([1])
    assert bench.got == {0: [1]}
    with pytest.raises(LeaseTaken):
        dead.check()


def test_a_failed_run_gives_its_lease_back(spark, folder):
    bench = Bench(spark, folder, "a")
    with pytest.raises(ZeroDivisionError):
        bench.run([1], lambda *_: 1 / 0)
    bench.run([1])
    assert bench.got == {0: [1]}


def test_a_run_loads_the_table_as_often_for_many_batches_as_for_one(spark, folder):
    loads = []

    def load():
        loads.append(1)
        return spark.range(0, 1000)

    for i, cap in enumerate((None, 50)):
        loads.clear()
        feed = IncrementalFeed(spark, FrameTable(load), {"offset.field": "id"}, f"{folder}/{i}", cap)
        done = feed.run_available(lambda batch, _: batch.count())
        assert len(done) == (1 if cap is None else 20) and len(loads) == 3


def test_old_log_entries_are_dropped_if_asked(spark, folder):
    bench = Bench(spark, folder, "a", retain=3)
    for last in range(1, 8):
        bench.run(list(range(1, last + 1)))
    log = bench.feed().log.frame().orderBy("batch_id").collect()
    assert [tuple(r) for r in log] == [(i, "a", str(i), str(i + 1)) for i in (4, 5, 6)]
    bench.run(list(range(1, 10)))
    assert bench.got[7] == [8, 9]


def test_an_unusable_offset_column_is_refused_at_once(spark, folder):
    with pytest.raises(ValueError, match="not in the schema"):
        Bench(spark, folder, "zz").feed()


# -- Parquet tables ----------------------------------------------------------


def test_parquet_files_that_appear_are_found(spark, folder):
    path = f"{folder}/table"
    spark.range(0, 10).write.parquet(path)
    table = ParquetTable(spark, path)
    got = {}
    feed = IncrementalFeed(spark, table, {"offset.field": "id"}, f"{folder}/log")

    def sink(batch, batch_id):
        got[batch_id] = batch.count()

    feed.run_available(sink)
    spark.range(10, 25).write.mode("append").parquet(path)
    feed.run_available(sink)
    assert got == {0: 10, 1: 15}


def test_parquet_bounds_without_usable_statistics(spark, folder):
    """A file with NULL offsets only has no statistics: the column is scanned instead."""
    path = f"{folder}/table"
    df = spark.createDataFrame([(1,), (5,)], "v int")
    df.write.parquet(path)
    df.select(F.lit(None).cast("int").alias("v")).write.mode("append").parquet(path)
    table = ParquetTable(spark, path)
    from tidemark.functions.offset_column import OffsetColumn

    c = OffsetColumn.of(table.schema, "v")
    assert table.bounds(c) == ("1", "5")
    assert table.bounds(c, "5") == (None, "5")
    assert table.bounds(c, "6") == (None, None)


@pytest.mark.parametrize("name", ["event_id", "ts", "event_type", "value"])
def test_parquet_bounds_equal_a_scan(spark, name):
    from tidemark.functions.offset_column import OffsetColumn

    path = "/root/testdata/sf0.001/events.parquet"
    table = ParquetTable(spark, path)
    plain = FrameTable(lambda: spark.read.parquet(path))
    c = OffsetColumn.of(table.schema, name)
    low, high = plain.bounds(c)
    assert table.bounds(c) == (low, high)
    assert table.bounds(c, high) == plain.bounds(c, high) == (None, high)


def test_probe_settings_stay_out_of_the_users_session(spark):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    table = ParquetTable(spark, "/root/testdata/sf0.001/events.parquet")
    from tidemark.functions.offset_column import OffsetColumn

    table.bounds(OffsetColumn.of(table.schema, "event_id"))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before != ""


# -- batch size ---------------------------------------------------------------


def delivered(spark, folder, df, field, rows):
    sizes, values = {}, Counter()

    def sink(batch, batch_id):
        got = [r[0] for r in batch.select(field).collect()]
        assert not set(got) & set(values), "a value was split over two batches"
        sizes[batch_id] = len(got)
        values.update(got)

    table = FrameTable(lambda: df)
    IncrementalFeed(
        spark, table, {"offset.field": field}, f"{folder}/log", rows_per_batch=rows
    ).run_available(sink)
    return sizes, values


@pytest.mark.parametrize("table, field", [
    ("events", "event_id"), ("events", "ts"), ("customer", "c_name"),
    ("part", "p_retailprice"), ("lineitem", "l_orderkey"), ("events", "event_type"),
])
def test_capped_batches_are_whole_and_within_the_cap(spark, folder, table, field):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    total = df.count()
    rows = total // 5
    sizes, values = delivered(spark, folder, df, field, rows)
    assert values == Counter(r[0] for r in df.select(field).collect())
    assert max(sizes.values()) <= max(rows, *values.values())
    assert 4 <= len(sizes) <= 15


def test_a_hot_value_is_one_batch(spark, folder):
    df = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, 400).otherwise(F.col("id")).cast("int").alias("v")
    )
    sizes, values = delivered(spark, folder, df, "v", 50)
    assert sum(sizes.values()) == 900 and values[400] == 300 + 1 * (400 % 3 != 0)
    assert sorted(sizes.values())[-1] == values[400] and sorted(sizes.values())[-2] <= 50


@pytest.mark.parametrize("first", [2**62, -(2**63), 2**63 - 1001])
def test_dense_keys_beyond_double_precision(spark, folder, first):
    sizes, values = delivered(spark, folder, spark.range(first, first + 1000), "id", 100)
    assert len(values) == 1000 and max(sizes.values()) <= 100


def test_keys_over_the_whole_range(spark, folder):
    df = spark.createDataFrame([(v,) for v in (-(2**63), -5, 0, 5, 2**63 - 1)], "v long")
    _, values = delivered(spark, folder, df, "v", 2)
    assert len(values) == 5


def test_collated_strings_are_followed_in_their_order(spark, folder):
    shown = [["A", "a", "b"], ["A", "a", "b", "C"]]
    table = FrameTable(
        lambda: spark.createDataFrame([(v,) for v in shown[0]], "v string COLLATE UTF8_LCASE")
    )
    got = []
    options = {"offset.field": "v"}
    for _ in range(2):
        feed = IncrementalFeed(spark, table, options, f"{folder}/log")
        feed.run_available(lambda batch, _: got.append(sorted(r.v for r in batch.collect())))
        shown.pop(0) if len(shown) > 1 else None
    assert got == [["A", "a", "b"], ["C"]]


def test_a_start_offset_far_below_the_data(spark, folder):
    df = spark.range(10**12, 10**12 + 1000)
    feed = IncrementalFeed(
        spark, FrameTable(lambda: df), {"offset.field": "id", "start.offset": "0"},
        f"{folder}/log", rows_per_batch=100,
    )
    sizes = []
    feed.run_available(lambda batch, _: sizes.append(batch.count()))
    assert sum(sizes) == 1000 and max(sizes) <= 100


def test_infinite_offsets_are_batches_of_their_own(spark, folder):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (2.0,), (inf,), (inf,), (-inf,)], "v double")
    sizes, _ = delivered(spark, folder, df, "v", 1)
    assert sizes == {0: 1, 1: 1, 2: 1, 3: 2}


@pytest.mark.parametrize(
    "values, kind",
    [
        ([10**20 + i for i in range(2000)], "decimal(38,0)"),
        ([-(10**37) * 9, *range(500), 10**37 * 9], "decimal(38,0)"),
        ([i * 1e-300 for i in range(1000)], "double"),
        ([-1.7e308, *map(float, range(500)), 1.7e308], "double"),
        ([-(2**63), *range(500), 2**63 - 1], "bigint"),
    ],
)
def test_the_cap_holds_for_far_and_close_offsets(spark, folder, values, kind):
    from decimal import Decimal

    cast = Decimal if kind.startswith("decimal") else lambda v: v
    df = spark.createDataFrame([(cast(v),) for v in values], f"v {kind}")
    sizes, got = delivered(spark, folder, df, "v", 100)
    assert sum(sizes.values()) == len(values) and max(sizes.values()) <= 100


def test_a_thousand_cuts_over_skewed_keys_take_three_reads(spark, folder, monkeypatch):
    import tidemark.operators.batch_cuts as cuts
    from tidemark.operators.ranges import BatchRange, read_range

    reads, counted = [], cuts._counted
    monkeypatch.setattr(cuts, "_counted", lambda *a: reads.append(1) or counted(*a))
    # A third on one key, most of the rest close together, and a long thin tail.
    df = spark.range(0, 300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 777 WHEN id % 1000 = 1 THEN id * 1000 ELSE id END AS v"
    )
    offset = OffsetColumn.of(df.schema, "v")
    whole = BatchRange(*fetch_bound(both_bounds(df, offset), offset), True)
    ends = cuts.batch_ends(lambda b: read_range(df, offset, b), offset, whole, 200)
    assert len(ends) > 1000 and len(reads) <= 3
    bounds, sizes, values = [int(e) for e in ends], Counter(), Counter()
    for row in df.groupBy("v").count().collect():
        batch = bisect_left(bounds, row["v"])
        sizes[batch] += row["count"]
        values[batch] += 1
    assert all(n <= 200 or values[batch] == 1 for batch, n in sizes.items())


@pytest.mark.parametrize(
    "values",
    [
        ["é", "éa", "éb", "ü"],
        ["", "a", "a\x00", "b"],
        ["x"] * 4,
        ["p" * 50 + s for s in ("", "a", "b" * 9, "b" * 9 + "c")] + ["zz"],
        ["\U0001f600", "\uffff", "\x7f"],
    ],
)
def test_capped_strings_keep_their_order(spark, folder, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    _, got = delivered(spark, folder, df, "v", 1)
    assert got == Counter(values)


def test_a_burst_far_from_the_rest_is_cut_too(spark, folder):
    """Nearly all rows lie within a millisecond, the first ones years before."""
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1e6) AS t "
        "FROM range(1, 4) UNION ALL "
        "SELECT TIMESTAMP_NTZ'2024-03-31 02:30:00' + make_dt_interval(0, 0, 0, id / 1e6) "
        "FROM range(0, 1000)"
    )
    sizes, values = delivered(spark, folder, df, "t", 100)
    assert len(values) == 1003 and max(sizes.values()) <= 100 and len(sizes) <= 15


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "float", "decimal(20,3)"])
def test_caps_hold_for_every_family_in_every_zone(spark, folder, kind, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Half-hours around a change of clocks.
        time = F.timestamp_seconds(F.lit(1710028800) + F.col("id") * 1800)
        value = time if kind in ("timestamp", "timestamp_ntz", "date") else F.col("id") * 0.25
        df = spark.range(0, 200).select(value.cast(kind).alias("v"))
        sizes, values = delivered(spark, folder, df, "v", 20)
        assert sum(values.values()) == 200
        assert max(sizes.values()) <= max(20, *values.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# -- landing ------------------------------------------------------------------


def test_landed_batches_are_a_stream_once_each(spark, folder):
    shown = [5]
    table = FrameTable(lambda: spark.range(0, shown[0]))
    landed = LandedStream(spark, table, {"offset.field": "id"}, folder)

    def drain():
        query = (
            landed.load().writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start(f"{folder}/out")
        )
        query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect())

    landed.land_available()
    assert drain() == list(range(5))
    shown[0] = 12
    landed.land_available()
    assert drain() == list(range(12))


def test_a_batch_that_landed_long_ago_is_still_streamed(spark, folder):
    shown = [5]
    landed = LandedStream(
        spark, FrameTable(lambda: spark.range(0, shown[0])), {"offset.field": "id"}, folder
    )

    def drain():
        query = (
            landed.load().writeStream.format("parquet")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start(f"{folder}/out")
        )
        query.awaitTermination()
        return spark.read.parquet(f"{folder}/out").count()

    landed.land_available()
    assert drain() == 5
    for shown[0] in (9, 12):
        landed.land_available()
    month_ago = time.time() - 30 * 86400
    for file in Path(folder).glob("landed/batch-1/*.parquet"):
        os.utime(file, (month_ago, month_ago))
    assert drain() == 12


def test_a_batch_in_place_before_its_commit_is_not_landed_again(spark, folder, monkeypatch):
    table = FrameTable(lambda: spark.range(0, 5))
    landed = LandedStream(spark, table, {"offset.field": "id"}, folder)

    def dies(batch_id):
        raise RuntimeError("died before the commit")

    monkeypatch.setattr(landed.feed.log, "commit", dies)
    with pytest.raises(RuntimeError):
        landed.land_available()
    again = LandedStream(spark, table, {"offset.field": "id"}, folder)
    (done,) = again.land_available()
    assert done.batch_id == 0
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/landed")
    assert files.count() == 5


def test_schema_comes_from_the_table(spark):
    table = ParquetTable(spark, "/root/testdata/sf0.001/events.parquet")
    assert isinstance(table.schema["ts"].dataType, T.TimestampNTZType)


@pytest.mark.parametrize("kind", ["byte", "short", "int", "long", "date"])
@pytest.mark.parametrize("rows", [[], [3, None, 1, 2]], ids=["empty", "rows"])
def test_footer_bounds_of_every_type_that_uses_them(spark, folder, kind, rows):
    from tidemark.functions.offset_column import OffsetColumn

    numbers = spark.createDataFrame([(r,) for r in rows], "n int")
    first = F.lit("2020-01-01").cast("date")
    value = F.date_add(first, F.col("n")) if kind == "date" else F.col("n")
    numbers.select(value.cast(kind).alias("v")).write.parquet(f"{folder}/table")
    table = ParquetTable(spark, f"{folder}/table")
    c = OffsetColumn.of(table.schema, "v")
    expected = ("2020-01-02", "2020-01-04") if kind == "date" else ("1", "3")
    assert table.bounds(c) == (expected if rows else (None, None))
    assert table.bounds(c, expected[1]) == (None, expected[1] if rows else None)
