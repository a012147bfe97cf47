import ast
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import days
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from catalog import tables
from tidemark.functions.offset_column import OffsetColumn
from tidemark.functions.offset_json import offset_dict
from tidemark.sources.parquet_footers import FooterIndex
from tidemark.streaming.datasource import TidemarkSource, read_stream, register
from tidemark.streaming.offset_log import read_spans

EVENTS = "/root/testdata/sf0.001/events.parquet"


def stream(spark, path, field, format_name="tidemark", **options):
    register(spark)
    return (
        spark.readStream.format(format_name)
        .option("offset.field", field).options(path=path, **options).load()
    )


def run(df, folder, name="out"):
    query = (
        df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start(f"{folder}/{name}")
    )
    query.awaitTermination()
    return query


def got(spark, folder, df, column):
    return sorted(r[0] for r in spark.read.schema(df.schema).parquet(f"{folder}/out").select(column).collect())


def write(path, name, rows, schema, **options):
    Path(path).mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(rows, schema=schema), f"{path}/{name}.parquet", **options)


LONGS = pa.schema([("id", pa.int64()), ("v", pa.string())])


def longs(path, name, ids, **options):
    write(path, name, {"id": ids, "v": [str(i) for i in ids]}, LONGS, **options)


# -- schema and options --------------------------------------------------------


def test_schema_is_the_tables(spark):
    df = stream(spark, EVENTS, "ts")
    assert df.isStreaming
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in spark.read.parquet(EVENTS).schema
    ]


def test_both_format_names_work(spark, folder):
    for i, name in enumerate(["tidemark", "jdbc-streaming-v1"]):
        df = stream(spark, EVENTS, "event_id", name)
        run(df, f"{folder}/{i}")
        assert len(got(spark, f"{folder}/{i}", df, "event_id")) == 1000


def test_a_declared_schema_that_differs_is_refused():
    source = TidemarkSource({"path": EVENTS, "offset.field": "ts"})
    with pytest.raises(ValueError, match="differs"):
        source.streamReader(T.StructType().add("f1", T.LongType()).add("f2", T.StringType()))


def test_the_tables_own_schema_may_be_declared():
    source = TidemarkSource({"path": EVENTS, "offset.field": "ts"})
    source.streamReader(source.schema())


@pytest.mark.parametrize(
    "options, message",
    [
        ({"path": EVENTS}, "'offset.field' is missing"),
        ({"path": EVENTS, "offset.field": "zz"}, "not in the schema"),
        ({"path": EVENTS, "offset.field": "ts", "offset.start": "1"}, "Unknown options"),
        ({"offset.field": "ts"}, "'path' or 'dbapi' is missing"),
        ({"offset.field": "ts", "url": "jdbc:h2:mem:x", "dbtable": "t"}, "LandedStream"),
        ({"offset.field": "ts", "dbapi": "duckdb"}, "'dbtable' is missing"),
    ],
)
def test_bad_options(options, message):
    schema = TidemarkSource({"path": EVENTS}).schema()
    with pytest.raises(ValueError, match=message):
        TidemarkSource(options).streamReader(schema)


def test_schema_is_mandatory():
    with pytest.raises(ValueError, match="schema is missing"):
        TidemarkSource({"path": EVENTS, "offset.field": "ts"}).streamReader(None)


# -- the reader, without a query -------------------------------------------------


def reader(path, field="id", **options):
    source = TidemarkSource({"path": path, "offset.field": field, **options})
    return source.streamReader(source.schema())


def ids(reader, start, end):
    rows = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            rows += batch.column(0).to_pylist()
    return sorted(rows)


def test_offsets_move_with_the_table(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1, 2, 5])
    r = reader(path)
    none = r.initialOffset()
    assert none == offset_dict("id")
    first = r.latestOffset()
    assert first == offset_dict("id", "1", "5")
    assert r.latestOffset() == first
    assert ids(r, none, first) == [1, 2, 5]
    longs(path, "b", [5, 6, 9])
    second = r.latestOffset()
    assert second == offset_dict("id", "5", "9")
    assert ids(r, first, second) == [6, 9]


def test_a_shrunk_table_never_moves_the_end_back(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1, 2])
    longs(path, "b", [3, 4])
    r = reader(path)
    first = r.latestOffset()
    (tmp_path / "b.parquet").unlink()
    assert r.latestOffset() == first == offset_dict("id", "1", "4")
    longs(path, "c", [3, 4, 5])
    second = r.latestOffset()
    assert ids(r, first, second) == [5]


def test_a_shrunk_table_never_moves_the_end_back_across_a_restart(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1, 2])
    end = offset_dict("id", "1", "4")
    r = reader(path)
    assert r.partitions(end, end) == []
    assert r.latestOffset() == end


def test_a_rewritten_file_is_read_anew(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1, 2, 3])
    r = reader(path)
    first = r.latestOffset()
    time.sleep(0.01)
    longs(path, "a", [3, 4, 5, 6])
    second = r.latestOffset()
    assert second == offset_dict("id", "3", "6")
    assert ids(r, first, second) == [4, 5, 6]


def test_committed_row_groups_are_forgotten_and_new_ones_found(tmp_path):
    path = str(tmp_path)
    longs(path, "a", list(range(100)), row_group_size=10)
    r = reader(path)
    first = r.latestOffset()
    r.commit(first)
    assert list(r._index._groups) == []
    assert r.latestOffset() == first
    longs(path, "b", list(range(95, 120)), row_group_size=10)
    assert ids(r, first, r.latestOffset()) == list(range(100, 120))


def test_an_empty_table_waits(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [])
    r = reader(path)
    none = r.latestOffset()
    assert none == offset_dict("id") and r.partitions(none, none) == []
    longs(path, "b", [7])
    assert ids(r, none, r.latestOffset()) == [7]


def test_start_offset_is_included_and_waits_for_data(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1, 2, 3])
    assert reader(path, **{"start.offset": "10"}).latestOffset() == offset_dict("id")
    r = reader(path, **{"start.offset": "2"})
    end = r.latestOffset()
    assert end == offset_dict("id", "2", "3")
    assert ids(r, r.initialOffset(), end) == [2, 3]


@pytest.mark.parametrize(
    "end", [offset_dict("id", "1", None), offset_dict("id", None, "5"), offset_dict("id")]
)
def test_ranges_need_both_bounds(tmp_path, end):
    longs(str(tmp_path), "a", [1])
    with pytest.raises(ValueError, match="Invalid range"):
        reader(str(tmp_path)).partitions(offset_dict("id", "0", "1"), end)


def test_a_checkpoint_of_another_column_is_refused(tmp_path):
    longs(str(tmp_path), "a", [1])
    other = offset_dict("v", "1", "2")
    with pytest.raises(ValueError, match="tracks 'v'"):
        reader(str(tmp_path)).partitions(other, other)


def test_tasks_are_runs_of_row_groups_that_can_match(tmp_path):
    path = str(tmp_path)
    longs(path, "a", list(range(0, 100)), row_group_size=10)
    longs(path, "b", list(range(100, 200)), row_group_size=10)
    r = reader(path, taskBytes="1")
    parts = r.partitions(offset_dict("id", "0", "44"), offset_dict("id", "44", "121"))
    groups = [(Path(p).stem, g) for part in parts for p, gs, _ in part.value[0] for g in gs]
    assert sorted(groups) == [("a", i) for i in range(4, 10)] + [("b", i) for i in range(3)]
    assert len(parts) == len(groups)
    assert ids(r, offset_dict("id", "0", "44"), offset_dict("id", "44", "121")) == list(range(45, 122))


def test_tasks_grow_with_the_batch_but_not_without_end():
    from tidemark.sources.parquet_footers import _task_size

    mega = 1024 * 1024
    assert _task_size(0, 8) == _task_size(60 * mega, 8) == 4 * mega
    assert _task_size(640 * mega, 8) == 40 * mega
    assert _task_size(100_000_000 * mega, 8) == 128 * mega


def test_wide_rows_come_in_small_batches(tmp_path):
    import random

    words = random.Random(1)
    wide = ["".join(words.choices("abcdefghij", k=100_000)) for _ in range(400)]
    write(str(tmp_path), "a", {"id": list(range(400)), "v": wide}, LONGS, use_dictionary=False)
    r = reader(str(tmp_path))
    (part,) = r.partitions(r.initialOffset(), r.latestOffset())
    sizes = [(b.num_rows, b.nbytes) for b in r.read(part)]
    assert sum(n for n, _ in sizes) == 400 and max(size for _, size in sizes) < 20_000_000


def test_only_row_groups_inside_the_range_skip_the_filter(tmp_path):
    path = str(tmp_path)
    longs(path, "a", list(range(0, 40)), row_group_size=10)
    write(path, "b", {"id": [15, None, 16], "v": ["x", "y", "z"]}, LONGS)
    r = reader(path)
    start, end = offset_dict("id", "0", "9"), offset_dict("id", "9", "34")
    whole = {(Path(p).stem, g): w for part in r.partitions(start, end) for p, gs, w in part.value[0] for g in gs}
    assert whole == {("a", 1): True, ("a", 2): True, ("a", 3): False, ("b", 0): False}
    assert ids(r, start, end) == sorted([*range(10, 35), 15, 16])
    first = offset_dict("id", "0", "9")
    (part,) = r.partitions(r.initialOffset(), first)
    assert [w for _, _, w in part.value[0]] == [True]
    shifted = reader(path)
    (part,) = shifted.partitions(offset_dict("id", "-5", "0"), first)
    assert [w for _, _, w in part.value[0]] == [False] and ids(shifted, offset_dict("id", "-5", "0"), first) == list(range(1, 10))


def test_partition_folders_become_columns(tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        longs(str(tmp_path / f"region=eu/day={day}"), "a", [int(day[-1])])
    (tmp_path / "_temporary").mkdir()
    longs(str(tmp_path / "_temporary"), "x", [99])
    declared = T.StructType().add("id", T.LongType()).add("v", T.StringType())
    declared = declared.add("region", T.StringType()).add("day", T.DateType())
    r = TidemarkSource({"path": str(tmp_path), "offset.field": "id"}).streamReader(declared)
    end = r.latestOffset()
    rows = [row for p in r.partitions(r.initialOffset(), end) for b in r.read(p) for row in b.to_pylist()]
    assert sorted((x["id"], x["region"], x["day"].isoformat()) for x in rows) == [
        (1, "eu", "2024-01-01"), (2, "eu", "2024-01-02"),
    ]


@pytest.mark.parametrize("query", ["stream_stepped", "drain_unclustered_ties"])
def test_more_rows_are_dealt_to_more_tasks(spark, monkeypatch, query):
    writes, parquet = [], DataFrameWriter.parquet

    def recorded(self, path, *args, **kwargs):
        parquet(self, path, *args, **kwargs)
        writes.append(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    monkeypatch.setattr(tables, "ROWS_A_FILE", 400)
    df = contract.queries()[query](spark, "/root/testdata/sf0.001")
    whole = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    sizes = [r["count"] for r in spark.read.parquet(writes[0]).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == whole.count() == df.count() and max(sizes) < 2 * 400
    assert df.exceptAll(whole).isEmpty()


def test_steps_are_refused_where_a_run_would_end_after_one(tmp_path):
    longs(str(tmp_path), "a", [1])
    with pytest.raises(ValueError, match="drain_stream"):
        reader(str(tmp_path), rowsPerBatch="1")


def test_nan_in_the_statistics_spark_writes(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame([(nan,), (1.0,), (5.0,), (None,)], "d double")
    df.coalesce(1).write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([(nan,)], "d double").write.mode("append").parquet(f"{tmp_path}/t")
    r = reader(f"{tmp_path}/t", "d")
    end = r.latestOffset()
    assert end == offset_dict("d", "1.0", "5.0")
    rows = [x["d"] for p in r.partitions(r.initialOffset(), end) for b in r.read(p) for x in b.to_pylist()]
    assert sorted(rows) == [1.0, 5.0]


def test_files_that_lack_a_later_column_give_nulls(tmp_path):
    longs(str(tmp_path), "a", [1])
    wide = pa.schema([*LONGS, pa.field("w", pa.int32())])
    write(str(tmp_path), "b", {"id": [2], "v": ["2"], "w": [7]}, wide)
    source = TidemarkSource({"path": f"{tmp_path}", "offset.field": "id"})
    schema = T.StructType().add("id", T.LongType()).add("v", T.StringType())
    r = source.streamReader(schema)
    assert ids(r, r.initialOffset(), r.latestOffset()) == [1, 2]


def test_missing_statistics_are_an_error(tmp_path):
    longs(str(tmp_path), "a", [1], write_statistics=False)
    with pytest.raises(ValueError, match="no statistics"):
        reader(str(tmp_path)).latestOffset()


def test_row_groups_of_nulls_only(tmp_path):
    longs(str(tmp_path), "a", [1, 2])
    write(str(tmp_path), "b", {"id": [None, None], "v": ["x", "y"]}, LONGS)
    write(str(tmp_path), "c", {"id": [None, 3], "v": ["x", "y"]}, LONGS)
    r = reader(str(tmp_path))
    end = r.latestOffset()
    assert end == offset_dict("id", "1", "3")
    assert ids(r, r.initialOffset(), end) == [1, 2, 3]


def test_nan_offsets_are_never_delivered(tmp_path):
    write(str(tmp_path), "a", {"id": [0.5, float("nan"), 2.0]}, pa.schema([("id", pa.float64())]))
    r = reader(str(tmp_path))
    end = r.latestOffset()
    assert end == offset_dict("id", "0.5", "2.0")
    assert ids(r, r.initialOffset(), end) == [0.5, 2.0]


def test_string_bounds_are_exact_even_if_statistics_are_not(tmp_path, monkeypatch):
    schema = pa.schema([("s", pa.string())])
    write(str(tmp_path), "a", {"s": ["b" * 40 + "1", "c"]}, schema)
    write(str(tmp_path), "b", {"s": ["zz" + "a" * 40, "z"]}, schema)
    offset = OffsetColumn.of(T.StructType().add("s", T.StringType()), "s")
    index = FooterIndex(str(tmp_path), offset)
    footer = index._footer

    def shortened(path):
        return [g._replace(least=g.least[:3], most=g.most[:2] + "~") for g in footer(path)]

    monkeypatch.setattr(index, "_footer", shortened)
    index.refresh()
    assert index.bounds(None) == ("b" * 40 + "1", "zz" + "a" * 40)


@pytest.mark.parametrize(
    "arrow_type, values",
    [
        (pa.int32(), [1, 2, 3]),
        (pa.float64(), [0.5, 2.0, 10.0]),
        (pa.decimal128(12, 2), None),
        (pa.date32(), days("2020-01-01", "2020-01-03")),
        (pa.timestamp("us"), [datetime(2024, 1, 1, 0, 0, i, 7) for i in range(3)]),
        (pa.timestamp("ms"), [datetime(2024, 1, 1, 0, 0, i) for i in range(3)]),
        (pa.string(), ["a", "b'", "c"]),
    ],
    ids=str,
)
def test_every_family_is_read_whole(tmp_path, arrow_type, values):
    from decimal import Decimal

    values = values or [Decimal("1.10"), Decimal("2.20"), Decimal("30.00")]
    write(str(tmp_path), "a", {"id": values}, pa.schema([("id", arrow_type)]))
    r = reader(str(tmp_path))
    end = r.latestOffset()
    assert ids(r, r.initialOffset(), end) == values


def test_types_come_as_spark_reads_them(spark, tmp_path):
    schema = pa.schema([
        ("id", pa.uint32()), ("big", pa.uint64()), ("tiny", pa.uint8()),
        ("word", pa.dictionary(pa.int32(), pa.string())), ("long", pa.large_string()),
    ])
    values = {
        "id": [1, 2**32 - 1], "big": [0, 2**64 - 1], "tiny": [0, 255],
        "word": pa.array(["x", "y"]).dictionary_encode(), "long": ["p", "q"],
    }
    path = str(tmp_path / "table")
    write(path, "a", values, schema)
    source = TidemarkSource({"path": path, "offset.field": "id"})
    native = spark.read.parquet(path)
    assert source.schema() == native.schema
    df = stream(spark, path, "id")
    run(df, str(tmp_path / "run"))
    rows = spark.read.schema(df.schema).parquet(str(tmp_path / "run/out"))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, native.collect()))


def test_timestamps_with_zone(tmp_path):
    kind = pa.timestamp("us", tz="UTC")
    write(str(tmp_path), "a", {"id": [0, 1_000_001]}, pa.schema([("id", kind)]))
    r = reader(str(tmp_path))
    end = r.latestOffset()
    assert end == offset_dict("id", "1970-01-01 00:00:00+00:00", "1970-01-01 00:00:01.000001+00:00")
    assert len(ids(r, r.initialOffset(), end)) == 2


def test_nanoseconds_are_refused(tmp_path):
    write(str(tmp_path), "a", {"id": [1]}, pa.schema([("id", pa.timestamp("ns"))]))
    with pytest.raises(ValueError, match="nanosecond"):
        reader(str(tmp_path))


def test_steps_never_split_ties_nor_stand_still(tmp_path):
    path = str(tmp_path)
    longs(path, "a", [1] * 30 + [2] * 5, row_group_size=10)
    longs(path, "b", [2] * 5 + [3] * 5 + [9], row_group_size=10)
    r = reader(path, rowsPerBatch="10", stepping="true")
    start, rows, ends = r.initialOffset(), [], []
    while (end := r.latestOffset()) != start:
        rows += [ids(r, start, end)]
        ends.append(end["fieldsOffsets"]["range"]["end"])
        start = end
    assert ends == ["1", "3", "9"]
    assert rows == [[1] * 30, [2] * 10 + [3] * 5, [9]]


@pytest.mark.parametrize("start", ["0", "2", "5"])
def test_steps_from_a_start_offset(tmp_path, start):
    path = str(tmp_path)
    longs(path, "a", list(range(10)), row_group_size=2)
    r = reader(path, rowsPerBatch="3", stepping="true", **{"start.offset": start})
    at, rows = r.initialOffset(), []
    while (end := r.latestOffset()) != at:
        rows += ids(r, at, end)
        at = end
    assert rows == list(range(int(start), 10))


def test_folder_values_keep_their_type(tmp_path):
    for name, i in (("n=1/s=x", 1), ("n=__HIVE_DEFAULT_PARTITION__/s=a%3Db", 2)):
        longs(str(tmp_path / name), "a", [i])
    source = TidemarkSource({"path": str(tmp_path), "offset.field": "id"})
    with pytest.raises(ValueError, match="partitioned by"):
        source.schema()
    declared = T.StructType().add("id", T.LongType()).add("v", T.StringType()).add("n", T.IntegerType()).add("s", T.StringType())
    r = source.streamReader(declared)
    rows = [x for p in r.partitions(r.initialOffset(), r.latestOffset()) for b in r.read(p) for x in b.to_pylist()]
    assert sorted((x["id"], x["n"], x["s"]) for x in rows) == [(1, 1, "x"), (2, None, "a=b")]


@pytest.mark.parametrize("log", ["_spark_metadata", "_delta_log", ".hoodie"])
def test_folders_with_a_log_of_their_own_are_refused(tmp_path, log):
    longs(str(tmp_path), "a", [1])
    (tmp_path / log).mkdir()
    with pytest.raises(ValueError, match="log"):
        reader(str(tmp_path))


def test_an_empty_folder_has_no_schema(tmp_path):
    with pytest.raises(ValueError, match="no Parquet files"):
        reader(str(tmp_path))


# -- under Structured Streaming --------------------------------------------------


def test_drain_into_memory(spark):
    query = (
        read_stream(spark, EVENTS, "event_id").writeStream.format("memory")
        .queryName("drained").start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("drained").count() == 1000


def test_running_query_follows_the_table(spark, folder):
    path = f"{folder}/table"
    longs(path, "a", [1, 2, 3])
    df = stream(spark, path, "id")
    query = (
        df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="200 milliseconds").start(f"{folder}/out")
    )
    try:
        query.processAllAvailable()
        longs(path, "b", [3, 4, 5])
        query.processAllAvailable()
        longs(path, "c", [2, 6])
        query.processAllAvailable()
        end = query.lastProgress["sources"][0]["endOffset"]
    finally:
        query.stop()
    assert got(spark, folder, df, "id") == [1, 2, 3, 4, 5, 6]
    assert ast.literal_eval(str(end)) == offset_dict("id", "5", "6")


def test_backlog_is_taken_in_steps(spark, folder):
    path = f"{folder}/table"
    for i in range(4):
        longs(path, f"f{i}", list(range(i * 100, i * 100 + 100)), row_group_size=25)
    df = stream(spark, path, "id", rowsPerBatch="50", stepping="true")
    query = (
        df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(processingTime="100 milliseconds").start(f"{folder}/out")
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert got(spark, folder, df, "id") == list(range(400))
    log = read_spans(spark, f"{folder}/checkpoint/offsets").orderBy("batch_id").collect()
    assert [int(r.end_offset) for r in log] == [49, 99, 149, 199, 249, 299, 349, 399]


def test_query_on_an_empty_table_starts_when_data_comes(spark, folder):
    path = f"{folder}/table"
    longs(path, "a", [])
    df = stream(spark, path, "id")
    run(df, folder)
    longs(path, "b", [1, 2])
    run(df, folder)
    longs(path, "c", [3])
    run(df, folder)
    assert got(spark, folder, df, "id") == [1, 2, 3]


def test_restart_delivers_the_rest_once(spark, folder):
    path = f"{folder}/table"
    df = None
    for i, name in enumerate("abc"):
        longs(path, name, list(range(i * 10, i * 10 + 10)))
        df = stream(spark, path, "id", **({"start.offset": "3"} if i == 0 else {"start.offset": "25"}))
        run(df, folder)
    assert got(spark, folder, df, "id") == list(range(3, 30))
    log = read_spans(spark, f"{folder}/checkpoint/offsets").orderBy("batch_id").collect()
    assert [tuple(r) for r in log] == [
        (0, "id", "3", "9"), (1, "id", "9", "19"), (2, "id", "19", "29"),
    ]


def test_failed_batch_is_replayed_with_its_logged_bounds(spark, folder):
    path = f"{folder}/table"
    longs(path, "a", [1, 2, 3])
    seen = Counter()

    def start(sink):
        query = (
            stream(spark, path, "id").writeStream
            .option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(sink)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def breaks(batch, batch_id):
        raise RuntimeError("sink is down")

    def keep(batch, batch_id):
        seen.update((batch_id, r.id) for r in batch.collect())

    with pytest.raises(StreamingQueryException):
        start(breaks)
    longs(path, "b", [4, 5])
    start(keep)
    start(keep)
    assert seen == Counter([(0, 1), (0, 2), (0, 3), (1, 4), (1, 5)])


def test_dates_start_and_follow(spark, folder):
    path = f"{folder}/table"
    schema = pa.schema([("d", pa.date32())])
    write(path, "a", {"d": days("2020-01-01", "2020-01-05")}, schema)
    options = {"start.offset": "2020-01-03", "offset.field.date.format": "YYYY-MM-DD"}
    df = stream(spark, path, "d", **options)
    run(df, folder)
    write(path, "b", {"d": days("2020-01-05", "2020-01-10")}, schema)
    run(df, folder)
    assert got(spark, folder, df, "d") == days("2020-01-03", "2020-01-10")


def test_columns_are_pruned(spark, folder):
    df = stream(spark, EVENTS, "event_id", columns="user_id, event_type")
    assert df.columns == ["user_id", "event_type"]
    run(df, folder)
    whole = spark.read.parquet(EVENTS).select("user_id")
    assert got(spark, folder, df, "user_id") == sorted(r[0] for r in whole.collect())


def test_tables_spark_wrote_come_back_as_they_were(spark, folder):
    ident = F.col("id")
    df = spark.range(0, 100).select(
        "id",
        F.timestamp_micros(ident + 1_700_000_000_000_001).alias("instant"),
        F.lit("x").cast("binary").alias("bytes"),
        F.array(ident).alias("list"),
        F.struct(ident, F.lit("q").alias("n")).alias("record"),
        F.to_json(F.create_map(F.lit("k"), ident)).alias("text"),
        ident.cast("decimal(12,3)").alias("amount"),
        ident.cast("short").alias("small"),
        (ident % 2 == 0).alias("even"),
        F.when(ident > 5, ident.cast("float")).alias("ratio"),
        F.lit(None).cast("date").alias("day"),
    )
    df.write.parquet(f"{folder}/table")
    streamed = stream(spark, f"{folder}/table", "id")
    assert streamed.schema == spark.read.parquet(f"{folder}/table").schema
    run(streamed, folder)
    rows = spark.read.schema(streamed.schema).parquet(f"{folder}/out")
    assert rows.count() == 100 and rows.exceptAll(df).count() == 0


def test_stream_joins_and_aggregates(spark, folder):
    events = stream(spark, EVENTS, "ts")
    users = spark.range(0, 100).withColumnRenamed("id", "user_id")
    counts = events.join(users, "user_id").groupBy("event_type").agg(F.count("*").alias("n"))
    query = (
        counts.writeStream.outputMode("complete").format("memory").queryName("joined")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = spark.read.parquet(EVENTS).join(users, "user_id").groupBy("event_type").count()
    assert sorted(map(tuple, spark.table("joined").collect())) == sorted(map(tuple, batch.collect()))


# -- DB-API --------------------------------------------------------------------
# DuckDB serves as the driver module; its "table" is a query over Parquet files, so
# every connection in every worker sees the same rows without any database.

TABLE = f"(SELECT * FROM read_parquet('{EVENTS}')) t"


def db_rows(r, piece):
    return [tuple(row.values()) for batch in r.read(piece) for row in batch.to_pylist()]


def db_reader(field, table=TABLE, **options):
    schema = TidemarkSource({"path": EVENTS}).schema()
    given = {"dbapi": "duckdb", "dbtable": table, "offset.field": field, **options}
    return TidemarkSource(given).streamReader(schema)


@pytest.mark.parametrize(
    "field, parts", [("event_id", 7), ("ts", 4), ("value", 3), ("event_type", 1)]
)
def test_db_table_is_read_in_disjoint_slices(field, parts):
    r = db_reader(field, numPartitions=str(max(parts, 2)))
    end = r.latestOffset()
    assert r.latestOffset() == end
    slices = r.partitions(r.initialOffset(), end)
    assert len(slices) == max(parts, 1 if field == "event_type" else 2)
    rows = [row for s in slices for row in db_rows(r, s)]
    assert sorted(row[0] for row in rows) == list(range(1000))


def test_db_table_moves_on_from_the_last_end():
    start, end = offset_dict("event_id", "0", "499"), offset_dict("event_id", "499", "700")
    r = db_reader("event_id")
    assert r.partitions(start, start) == []
    assert r.latestOffset() == offset_dict("event_id", "499", "999")
    (piece,) = r.partitions(start, end)
    assert sorted(row[0] for row in db_rows(r, piece)) == list(range(500, 701))


def test_db_table_is_split_over_another_column():
    """All rows share one offset value; the users spread them, one user is unknown."""
    table = (
        "(SELECT * REPLACE (NULLIF(user_id, 3) AS user_id), 7 AS hot "
        f"FROM read_parquet('{EVENTS}')) t"
    )
    split = {"partitionColumn": "user_id", "lowerBound": "0", "upperBound": "15"}
    schema = T.StructType().add("event_id", T.LongType()).add("hot", T.IntegerType())
    given = {"dbapi": "duckdb", "dbtable": table, "offset.field": "hot", "numPartitions": "4", **split}
    r = TidemarkSource(given).streamReader(schema)
    parts = r.partitions(r.initialOffset(), r.latestOffset())
    sizes = [db_rows(r, p) for p in parts]
    assert len(sizes) == 4 and all(sizes)
    assert sorted(row[0] for rows in sizes for row in rows) == list(range(1000))


def test_db_values_are_bound_not_spliced():
    table = "(SELECT 1 AS n, 'a''b{x}' AS s UNION ALL SELECT 2, 'z') t"
    schema = T.StructType().add("n", T.IntegerType()).add("s", T.StringType())
    given = {"dbapi": "duckdb", "dbtable": table, "offset.field": "s", "start.offset": "a'b"}
    r = TidemarkSource(given).streamReader(schema)
    end = r.latestOffset()
    assert end == offset_dict("s", "a'b", "z")
    (piece,) = r.partitions(r.initialOffset(), end)
    assert sorted(db_rows(r, piece)) == [(1, "a'b{x}"), (2, "z")]


def test_db_percent_signs_and_typed_arguments(monkeypatch):
    """A driver that marks parameters by %s, and whose connect tells types and case apart."""
    import sys
    import types

    import duckdb

    calls = []

    def connect(**given):
        calls.append(given)
        own = duckdb.connect()

        class Cursor:
            def execute(self, sql, bound=None):
                # As such drivers do: with parameters, %% is a percent sign.
                self.result = own.execute(sql if bound is None else sql.replace("%s", "?").replace("%%", "%"), bound or [])

            def fetchmany(self, n):
                return self.result.fetchmany(n)

        return types.SimpleNamespace(cursor=Cursor, close=own.close)

    driver = types.ModuleType("percent_driver")
    driver.paramstyle, driver.connect = "pyformat", connect
    monkeypatch.setitem(sys.modules, "percent_driver", driver)
    table = f"(SELECT * FROM read_parquet('{EVENTS}') WHERE event_type LIKE 'c%') t"
    schema = T.StructType().add("event_id", T.LongType()).add("event_type", T.StringType())
    given = {"dbapi": "percent_driver", "dbtable": table, "offset.field": "event_id", "dbapi.connect": '{"Port": 1, "readOnly": true}'}
    r = TidemarkSource(given).streamReader(schema)
    (piece,) = r.partitions(r.initialOffset(), r.latestOffset())
    rows = db_rows(r, piece)
    assert rows and all(row[1].startswith("c") for row in rows)
    assert calls[0] == {"Port": 1, "readOnly": True}


def test_db_stream_under_spark(spark, folder):
    register(spark)
    schema = spark.read.parquet(EVENTS).schema
    df = (
        spark.readStream.format("jdbc-streaming-v1").schema(schema)
        .options(dbapi="duckdb", dbtable=TABLE, numPartitions="3")
        .option("offset.field", "event_id").load()
    )
    run(df, folder)
    rows = spark.read.schema(schema).parquet(f"{folder}/out")
    assert rows.exceptAll(spark.read.parquet(EVENTS)).count() == 0 and rows.count() == 1000


def test_db_table_needs_a_declared_schema():
    with pytest.raises(ValueError, match="declared"):
        TidemarkSource({"dbapi": "duckdb", "dbtable": TABLE, "offset.field": "ts"}).schema()
