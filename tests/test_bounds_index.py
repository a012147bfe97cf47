"""The table of file bounds: what it holds, what it opens, and who reads through it."""

import os
from datetime import date, datetime, timedelta
from hashlib import sha256
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.ranges import BatchRange
from tidemark.sources import bounds_index
from tidemark.sources.bounds_index import BoundsIndex, only_files
from tidemark.sources.tables import ParquetTable
from tidemark.streaming.datasource import drain_stream, read_stream
from tidemark.streaming.feed import IncrementalFeed, parquet_sink

NAN = float("nan")


def write(spark, folder, rows, schema, mode="append", files=1):
    spark.createDataFrame(rows, schema).coalesce(files).write.mode(mode).parquet(folder)


def index_of(spark, folder, field):
    schema = spark.read.parquet(f"{folder}/t").schema
    return BoundsIndex(spark, f"{folder}/t", f"{folder}/index", OffsetColumn.of(schema, field), schema)


def spoil(folder):
    """Fill the data files with zeros, so that whoever opens one fails; size and time stay."""
    for file in Path(folder).rglob("*.parquet"):
        stat = file.stat()
        file.write_bytes(b"\0" * stat.st_size)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


CASES = {
    "double": ("double", [[1.5, NAN, None, 0.25], [NAN, 9.0, -3.0], [NAN], [None], [12.0]], ("-3.0", "12.0"), (2, 3)),
    "long": ("long", [[5, None, 1], [9], [None], [11, 11]], ("1", "11"), (2, 0)),
    "string": ("string", [["b" * 200 + "z", "a"], ["b" * 200 + "y"], [None, "é"]], ("a", "é"), (1, 0)),
    "date": ("date", [[date(2020, 1, 5)], [date(2019, 1, 1), None]], ("2019-01-01", "2020-01-05"), (1, 0)),
    "instant": ("timestamp", [[datetime(2020, 1, 1, 5)], [datetime(2020, 1, 1, 6, 0, 0, 1)]],
                ("2020-01-01 05:00:00+00:00", "2020-01-01 06:00:00.000001+00:00"), (0, 0)),
}


@pytest.mark.parametrize("case", CASES)
def test_a_second_start_opens_new_files_only(spark, folder, case):
    kind, steps, bounds, (nulls, nans) = CASES[case]
    for step in steps[:-1]:
        write(spark, f"{folder}/t", [(v, 1) for v in step], f"o {kind}, x int")
    index = index_of(spark, folder, "o")
    assert index.refresh() == len(steps) - 1
    assert index.refresh() == 0
    spoil(f"{folder}/t")
    write(spark, f"{folder}/t", [(v, 1) for v in steps[-1]], f"o {kind}, x int")
    schema = spark.createDataFrame([], f"o {kind}, x int").schema
    again = BoundsIndex(spark, f"{folder}/t", f"{folder}/index", OffsetColumn.of(schema, "o"), schema)
    assert again.refresh() == 1
    assert again.bounds() == bounds and again.bounds(bounds[1]) == (None, bounds[1])
    row = again.summary().first()
    assert (row.n_files, row.n_rows, row.n_nulls, row.n_nans) == (len(steps), sum(map(len, steps)), nulls, nans)


def test_bounds_from_beyond_the_end_are_none(spark, folder):
    write(spark, f"{folder}/t", [(1,), (2,)], "o long")
    index = index_of(spark, folder, "o")
    assert index.bounds() == (None, None)  # nothing is known before the first refresh
    index.refresh()
    assert index.bounds("2") == (None, "2") and index.bounds("3") == (None, None)


def test_files_that_go_or_change(spark, folder):
    for i in range(3):
        write(spark, f"{folder}/t", [(i * 10 + k,) for k in range(5)], "o long")
    index = index_of(spark, folder, "o")
    index.refresh()
    first, second, third = sorted(Path(f"{folder}/t").glob("*.parquet"), key=lambda f: spark.read.parquet(str(f)).first()[0])
    (third.parent / f".{third.name}.crc").unlink()
    third.unlink()
    (second.parent / f".{second.name}.crc").unlink()
    second.write_bytes(first.read_bytes() + b"")  # rewritten: the rows of another file
    os.utime(second, (1, 1))
    assert index.refresh() == 1
    assert index.bounds() == ("0", "4")
    assert index.summary().first().n_rows == 10
    # A file that comes back as it was counts again.
    second.write_bytes(first.read_bytes())
    os.utime(second, (2, 2))
    assert index.refresh() == 1 and index.summary().first().n_rows == 10


def test_empty_files_are_read_once(spark, folder):
    write(spark, f"{folder}/t", [], "o long")
    write(spark, f"{folder}/t", [(4,)], "o long")
    index = index_of(spark, folder, "o")
    n = len(list(Path(f"{folder}/t").glob("*.parquet")))
    assert index.refresh() == n and index.refresh() == 0 and index.bounds() == ("4", "4")


def test_many_parts_become_one(spark, folder, monkeypatch):
    monkeypatch.setattr(bounds_index, "GATHER_AT", 3)
    monkeypatch.setattr(bounds_index, "PATHS", 2)
    for i in range(9):
        write(spark, f"{folder}/t", [(i,)], "o long")
        if i % 2:
            index_of(spark, folder, "o").refresh()
    index = index_of(spark, folder, "o")
    index.refresh()
    assert len(index._parts()) < 4 and index.summary().first().n_rows == 9 and index.bounds() == ("0", "8")


def test_two_writers_at_once_count_once(spark, folder):
    write(spark, f"{folder}/t", [(1,), (2,)], "o long")
    index, other = index_of(spark, folder, "o"), index_of(spark, folder, "o")
    fresh = bounds_index._listed(spark, f"{folder}/t")
    files = [tuple(r) for r in fresh.collect()]
    for one in (index, other):
        one._write(one._measured(files), 0)
    assert index.summary().first().n_rows == 2
    # A part that was not written to its end does not count.
    broken = Path(index._folder) / "0000000001-abc-part"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert index.refresh() == 0 and index.summary().first().n_rows == 2


def test_a_batch_opens_only_files_that_can_hold_it(spark, folder):
    for i in range(6):
        write(spark, f"{folder}/t", [(float(i * 10 + k), i) for k in range(10)] + [(NAN, -1)], "o double, part int")
    table = ParquetTable(spark, f"{folder}/t", index=f"{folder}/index")
    offset = OffsetColumn.of(table.schema, "o")
    assert table.bounds(offset) == ("0.0", "59.0")
    paths = sorted(Path(f"{folder}/t").glob("*.parquet"), key=lambda f: spark.read.parquet(str(f)).agg(F.max("part")).first()[0])
    for i in (0, 1, 4, 5):  # the range lies in files 2 and 3
        paths[i].write_bytes(b"\0" * paths[i].stat().st_size)
        (paths[i].parent / f".{paths[i].name}.crc").unlink()
    batch = BatchRange("19.0", "35.0")
    for source in (table, table.pinned()):
        assert sorted(r.o for r in source.read(offset, batch).collect()) == [float(k) for k in range(20, 36)]


def test_folders_with_odd_names(spark, folder):
    rows = [(i, f"a b%{i % 2}", i) for i in range(20)]
    spark.createDataFrame(rows, "o long, p string, x int").write.partitionBy("p").parquet(f"{folder}/t")
    table = ParquetTable(spark, f"{folder}/t", index=f"{folder}/index")
    offset = OffsetColumn.of(table.schema, "o")
    assert table.bounds(offset) == ("0", "19")
    got = table.read(offset, BatchRange("3", "9", True))
    assert sorted((r.o, r.p) for r in got.collect()) == [(i, f"a b%{i % 2}") for i in range(3, 10)]
    only = only_files(spark.read.parquet(f"{folder}/t"), table.index(offset).files(BatchRange("3", "3", True)))
    held = {r.o for r in only.collect()}
    assert 3 in held and 19 not in held and len(held) < 20
    stream = read_stream(spark, f"{folder}/t", "o", index=f"{folder}/index")
    assert drained(spark, folder, lambda: stream) == sorted(rows)


def drained(spark, folder, load, columns=("o", "p", "x")):
    query = load().writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")
    query.awaitTermination()
    return sorted(tuple(r[c] for c in columns) for r in spark.read.parquet(f"{folder}/out").collect())


def test_a_feed_over_an_indexed_table(spark, folder):
    rng = [(float(i * 37 % 100), i) for i in range(100)] + [(NAN, -1), (None, -2)]
    table = ParquetTable(spark, f"{folder}/t", index=f"{folder}/index")
    got = []
    for part in (rng[:40], rng[40:]):
        write(spark, f"{folder}/t", part, "o double, x int", files=3)
        IncrementalFeed(spark, table, {"offset.field": "o"}, f"{folder}/log").run_available(parquet_sink(f"{folder}/out"))
    got = {r.x for r in spark.read.parquet(f"{folder}/out").collect()}
    first = max(o for o, x in rng[:40])
    assert got == {x for o, x in rng[:40]} | {x for o, x in rng[40:100] if o > first}


@pytest.mark.parametrize("field, kind", [("o", "double"), ("s", "string"), ("t", "timestamp_ntz"), ("t", "timestamp")])
def test_a_stream_over_an_indexed_table(spark, folder, field, kind):
    """Many row groups and blocks in a file, NaN everywhere; planning opens no file."""
    def rows(first, last):
        out = [(float(i), f"{i:06d}" + sha256(b"%d" % i).hexdigest(), datetime(2020, 1, 1) + timedelta(microseconds=i), i) for i in range(first, last)]
        return [r if i % 50 else (NAN, None, None, -1) for i, r in enumerate(out)]

    schema = f"o double, s string, t {'timestamp' if kind == 'timestamp' else 'timestamp_ntz'}, x int"
    place = f"{folder}/t"
    conf = {"parquet.block.size": "20000", "parquet.page.size": "2000"}

    def put(first, last):
        spark.createDataFrame(rows(first, last), schema).coalesce(1).write.options(**conf).mode("append").parquet(place)

    put(0, 3000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        read_stream(spark, place, field, index=f"{folder}/index")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    entries = index_of(spark, folder, field).live()
    assert entries.count() > 3, "the file has several blocks"

    def start():
        stream = read_stream(spark, place, field, index=f"{folder}/index", rowsPerBatch="700", stepping="true", taskBytes="20000")
        return stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")

    drain_stream(start)
    put(3000, 4000)
    assert drain_stream(start) >= 2
    got = sorted(r.x for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == sorted(r[3] for r in rows(0, 3000) + rows(3000, 4000) if r[3] >= 0)


def test_following_in_the_background(spark, folder):
    write(spark, f"{folder}/t", [(1,)], "o long")
    index = index_of(spark, folder, "o")
    with index.following(seconds=0.05) as refresh:
        write(spark, f"{folder}/t", [(2,)], "o long")
        refresh()
        assert index.bounds() == ("1", "2")
    with pytest.raises(Exception, match="(?i)parquet|corrupt"), index.following(seconds=0.01) as refresh:
        (Path(f"{folder}/t") / "broken.parquet").write_bytes(b"no file of this kind")
        refresh()
