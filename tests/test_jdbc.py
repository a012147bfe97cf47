"""The JDBC table without a database: what it asks of Spark's reader, and if the SQL is right."""

from datetime import datetime
from functools import reduce

import duckdb
import pytest
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.ranges import BatchRange
from tidemark.sources.jdbc import JdbcTable
from tidemark.streaming.feed import IncrementalFeed
from tidemark.streaming.landing import LandedStream

EVENTS = "read_parquet('/root/testdata/sf0.001/events.parquet')"
OPTIONS = {
    "url": "jdbc:postgresql://host/db",
    "driver": "org.postgresql.Driver",
    "dbtable": EVENTS,
    "user": "u",
    "offset.field": "event_id",
    "start.offset": "5",
}


def column(name, data_type):
    return OffsetColumn.of(T.StructType([T.StructField(name, data_type)]), name)


class Recorder:
    """Stands where the session's JDBC reader is and keeps the options of each load."""

    def __init__(self, spark, result):
        self._spark, self._result, self.loads = spark, result, []
        self._jvm = spark._jvm

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.loads.append(options)
        return self

    def load(self):
        if "NTILE" in self.loads[-1].get("query", ""):
            self.loads.pop()  # where to cut: at 4
            return self._result.sparkSession.createDataFrame([(1, 4), (2, 6)], "part int, end_offset long")
        return self._result

    def jdbc(self, url, table, predicates, properties):
        self.loads.append({**properties, "url": url, "dbtable": table, "predicates": predicates})
        return self._result


@pytest.mark.parametrize("missing", ["url", "dbtable"])
def test_mandatory_options(spark, missing):
    with pytest.raises(ValueError, match=missing):
        JdbcTable(spark, {k: v for k, v in OPTIONS.items() if k != missing})


@pytest.mark.parametrize(
    "name, data_type, at_least, least, most",
    [
        ("event_id", T.LongType(), "500", 0, 999),
        ("value", T.DoubleType(), "100.5", None, None),
        ("event_type", T.StringType(), "it's", None, None),
        ("ts", T.TimestampNTZType(), "2024-01-10 12:00:00.000001", None, None),
    ],
)
def test_probe_sql_finds_the_bounds(spark, name, data_type, at_least, least, most):
    """DuckDB reads the same quoting and literals as the dialect of this URL."""
    table, c = JdbcTable(spark, OPTIONS), column(name, data_type)
    con = duckdb.connect()
    low, high = con.execute(f"SELECT MIN({name}), MAX({name}) FROM {EVENTS}").fetchone()
    if least is not None:
        assert (low, high) == (least, most)
    assert con.execute(table.probe_query(c)).fetchone() == (low, high)
    last = con.execute(table.probe_query(c, at_least)).fetchone()
    assert last == con.execute(
        f"SELECT MAX({name}) FROM {EVENTS} WHERE {name} >= ?", [c.parse(at_least)]
    ).fetchone()


def test_probe_names_its_columns(spark):
    sql = JdbcTable(spark, OPTIONS).probe_query(column("event_id", T.LongType()))
    assert sql == (
        f'SELECT MIN("event_id") AS start_offset, MAX("event_id") AS end_offset FROM {EVENTS}'
    )


@pytest.mark.parametrize(
    "url, quoted",
    [("jdbc:mysql://h/d", "`event_id`"), ("jdbc:oracle:thin:@h", '"event_id"')],
)
def test_quoting_follows_the_database(spark, url, quoted):
    table = JdbcTable(spark, {**OPTIONS, "url": url})
    assert quoted in table.probe_query(column("event_id", T.LongType()))


def test_literals_follow_the_database(spark):
    table = JdbcTable(spark, {**OPTIONS, "url": "jdbc:oracle:thin:@h"})
    sql = table.probe_query(column("d", T.DateType()), "2020-01-05")
    assert sql.endswith("WHERE \"d\" >= {d '2020-01-05'}")
    sql = table.probe_query(column("t", T.TimestampNTZType()), "2020-01-05 00:00:00.000007")
    assert sql.endswith("WHERE \"t\" >= {ts '2020-01-05 00:00:00.000007'}")


def test_quotes_in_string_offsets_are_escaped(spark):
    sql = JdbcTable(spark, OPTIONS).probe_query(column("e", T.StringType()), "a' OR '1'='1")
    assert sql.endswith("WHERE \"e\" >= 'a'' OR ''1''=''1'")


def test_probe_ignores_splits_and_own_options(spark):
    """Split options name columns the probe does not have; ours mean nothing to the reader."""
    split = {"partitionColumn": "k", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    recorder = Recorder(spark, spark.sql("SELECT 1L AS start_offset, 9L AS end_offset"))
    table = JdbcTable(recorder, {**OPTIONS, **split})
    assert table.bounds(column("event_id", T.LongType())) == ("1", "9")
    (asked,) = recorder.loads
    assert set(asked) == {"url", "driver", "user", "query"}


def test_probe_from_a_floor(spark):
    recorder = Recorder(spark, spark.sql("SELECT CAST(NULL AS LONG) AS end_offset"))
    table = JdbcTable(recorder, OPTIONS)
    assert table.bounds(column("event_id", T.LongType()), "7") == (None, None)
    assert recorder.loads[0]["query"].endswith('WHERE "event_id" >= 7')


@pytest.mark.parametrize(
    "name, data_type, start, end, parts",
    [
        ("event_id", T.LongType(), "100", "900", 8),
        ("value", T.DoubleType(), "0.5", "99.25", 8),
        ("ts", T.TimestampNTZType(), "2024-01-02 00:00:00.000001", "2024-01-20 00:00:00", 8),
        ("event_type", T.StringType(), "click", "signup", 1),
    ],
)
@pytest.mark.parametrize("inclusive", [True, False])
def test_batch_is_split_over_the_offset_range(spark, name, data_type, start, end, parts, inclusive):
    """The connections' conditions select every row of the batch, and each row once."""
    table, c = JdbcTable(spark, {**OPTIONS, "numPartitions": "8"}), column(name, data_type)
    predicates = table.predicates(c, BatchRange(start, end, inclusive))
    assert len(predicates) == parts
    con = duckdb.connect()
    whole = f"{name} {'>=' if inclusive else '>'} ? AND {name} <= ?"
    expected = con.execute(
        f"SELECT event_id FROM {EVENTS} WHERE {whole}", [c.parse(start), c.parse(end)]
    ).fetchall()
    found = [
        row
        for p in predicates
        for row in con.execute(f"SELECT event_id FROM {EVENTS} WHERE {p}").fetchall()
    ]
    assert expected and sorted(found) == sorted(expected)


@pytest.mark.parametrize("name, data_type, start, end", [
    ("event_id", T.LongType(), "100", "900"),
    ("value", T.DoubleType(), "0.5", "99.25"),
    ("ts", T.TimestampNTZType(), "2024-01-02 00:00:00.000001", "2024-01-20 00:00:00"),
    ("event_type", T.StringType(), "click", "signup"),
    ("hot", T.LongType(), "0", "900"),
])
@pytest.mark.parametrize("inclusive", [True, False])
def test_connections_get_equally_many_rows(spark, name, data_type, start, end, inclusive):
    """Cut by the database's counts; ``hot`` has a third of its rows on one value."""
    con, c = duckdb.connect(), column(name, data_type)
    con.execute(
        "CREATE VIEW t AS SELECT *, CASE WHEN event_id % 3 = 0 THEN 500 ELSE event_id END AS hot FROM " + EVENTS
    )
    table = JdbcTable(DuckReader(spark, con), {**OPTIONS, "dbtable": "t"})
    batch = BatchRange(start, end, inclusive)
    predicates = table.predicates(c, batch, table._ends(c, batch, 8))
    (whole,) = table.predicates(c, batch, [end])
    expected = sorted(con.execute(f"SELECT event_id FROM t WHERE {whole}").fetchall())
    found = [con.execute(f"SELECT event_id FROM t WHERE {p}").fetchall() for p in predicates]
    assert sorted(sum(found, [])) == expected and all(found)
    if name == "event_type":
        assert len(found) == len({r[0] for r in con.execute(f"SELECT event_type FROM t WHERE {whole}").fetchall()})
    elif name == "hot":
        assert sorted(map(len, found))[-2] <= len(expected) / 7
    else:
        assert max(map(len, found)) <= len(expected) / 8 + 3


@pytest.mark.parametrize("data_type", [T.DateType(), T.DecimalType(9, 2), T.TimestampType()])
def test_other_families_split_too(spark, data_type):
    decimal = isinstance(data_type, T.DecimalType)
    bounds = ("1.00", "9.00") if decimal else ("2020-01-01", "2020-12-31")
    table = JdbcTable(spark, {**OPTIONS, "numPartitions": "4"})
    assert len(table.predicates(column("c", data_type), BatchRange(*bounds))) == 4


def rows_of(recorder, options, batch):
    rows = JdbcTable(recorder, options).read(column("event_id", T.LongType()), batch)
    return [r.event_id for r in rows.collect()]


def test_the_users_own_split_column_wins(spark):
    """For a hot offset value: the batch is split over another column."""
    split = {"partitionColumn": "k", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    recorder = Recorder(spark, spark.range(0, 10).withColumnRenamed("id", "event_id"))
    assert rows_of(recorder, {**OPTIONS, **split}, BatchRange("7", "9")) == [8, 9]
    (asked,) = recorder.loads
    assert {k: asked[k] for k in split} == split
    assert "offset.field" not in asked and "predicates" not in asked


@pytest.mark.parametrize("parts, split", [("1", False), ("2", True)])
def test_batch_carries_its_range_filter(spark, parts, split):
    recorder = Recorder(spark, spark.range(0, 10).withColumnRenamed("id", "event_id"))
    options = {**OPTIONS, "numPartitions": parts}
    assert rows_of(recorder, options, BatchRange("3", "6")) == [4, 5, 6]
    (asked,) = recorder.loads
    assert ("predicates" in asked) == split
    assert asked["dbtable"] == EVENTS and asked["fetchsize"] == "10000" and asked["user"] == "u"
    assert "numPartitions" not in asked


def test_a_given_fetch_size_is_kept(spark):
    recorder = Recorder(spark, spark.range(0, 10).withColumnRenamed("id", "event_id"))
    rows_of(recorder, {**OPTIONS, "fetchSize": "77", "numPartitions": "1"}, BatchRange("3", "6"))
    assert recorder.loads[0]["fetchSize"] == "77" and "fetchsize" not in recorder.loads[0]


def test_timestamps_with_zone_use_the_jvm_clock(spark):
    """The driver hands over wall-clock times in the JVM's zone, so the literal does too."""
    table = JdbcTable(spark, OPTIONS)
    text = "2024-01-10 12:00:00.000001+00:00"
    sql = table.probe_query(column("t", T.TimestampType()), text)
    zone = spark._jvm.java.util.TimeZone.getDefault().toZoneId().getId()
    from zoneinfo import ZoneInfo

    wall = datetime.fromisoformat(text).astimezone(ZoneInfo(zone))
    assert sql.endswith(f"'{wall:%Y-%m-%d %H:%M:%S.%f}'")


# -- a whole feed ------------------------------------------------------------


class DuckReader:
    """Spark's JDBC reader, with DuckDB answering the SQL that a database would get."""

    def __init__(self, spark, con):
        self._spark, self._con, self._jvm = spark, con, spark._jvm
        self.asked = []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self._given = options
        return self

    def _run(self, sql):
        self.asked.append(sql)
        return self._spark.createDataFrame(self._con.execute(sql).to_arrow_table())

    def load(self):
        return self._run(self._given.get("query") or f"SELECT * FROM {self._given['dbtable']}")

    def jdbc(self, url, table, predicates, properties):
        parts = [self._run(f"SELECT * FROM {table} WHERE {p}") for p in predicates]
        return reduce(lambda a, b: a.unionAll(b), parts)


@pytest.mark.parametrize("field", ["event_id", "ts", "value", "event_type"])
@pytest.mark.parametrize("parts", ["1", "4"])
def test_feed_follows_a_growing_table(spark, folder, field, parts):
    con = duckdb.connect()

    def show(share):
        con.execute(
            f"CREATE OR REPLACE VIEW shown AS SELECT * FROM {EVENTS} WHERE {field} <= "
            f"(SELECT quantile_disc({field}, {share}) FROM {EVENTS})"
        )

    got = {}

    def sink(batch, batch_id):
        got[batch_id] = [r.event_id for r in batch.collect()]

    for share in (0.3, 0.3, 0.7, 1.0):
        show(share)
        reader = DuckReader(spark, con)
        table = JdbcTable(reader, {**OPTIONS, "dbtable": "shown", "numPartitions": parts})
        feed = IncrementalFeed(spark, table, {"offset.field": field}, f"{folder}/log")
        feed.run_available(sink)
        assert [q for q in reader.asked if "MAX(" in q and "NTILE" not in q][0].count("MAX(") == 1
    delivered = [i for ids in got.values() for i in ids]
    assert len(got) == 3 and sorted(delivered) == list(range(1000))


def test_a_jdbc_table_becomes_a_stream(spark, folder):
    """Landed batches feed a running aggregation, as the table grows."""
    con = duckdb.connect()
    for last in (400, 999):
        con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM {EVENTS} WHERE event_id <= {last}")
        table = JdbcTable(DuckReader(spark, con), {**OPTIONS, "dbtable": "t", "numPartitions": "2"})
        landed = LandedStream(spark, table, {"offset.field": "ts"}, folder)
        landed.land_available()
        query = (
            landed.load().groupBy("event_type").count().writeStream.outputMode("complete")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(lambda full, _: full.write.mode("overwrite").parquet(f"{folder}/out"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    counts = sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect()))
    assert counts == con.execute(
        f"SELECT event_type, COUNT(*) FROM {EVENTS} GROUP BY 1 ORDER BY 1"
    ).fetchall()


@pytest.mark.parametrize("cap", [1, 5, 40, 300, 5000])
def test_strings_over_jdbc_are_cut_in_the_databases_order(spark, folder, cap):
    """Upper and lower case are the same to the database, which orders and equates by its collation."""
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE t (event_id BIGINT, name VARCHAR COLLATE NOCASE); "
        f"INSERT INTO t SELECT event_id, CASE event_id % 2 WHEN 0 THEN 'n' ELSE 'N' END || "
        f"CASE WHEN event_id % 3 = 0 THEN 5 ELSE event_id * 7 % 90 END FROM {EVENTS}"
    )
    reader = DuckReader(spark, con)
    got = {}
    for _ in range(2):  # the second finds nothing: another text of the last value is no movement
        table = JdbcTable(reader, {**OPTIONS, "dbtable": "t", "numPartitions": "3"})
        feed = IncrementalFeed(spark, table, {"offset.field": "name"}, f"{folder}/log", rows_per_batch=cap)
        feed.run_available(lambda batch, i: got.setdefault(i, [r.name.lower() for r in batch.collect()]))
    assert sum(map(len, got.values())) == 1000
    assert all(len(v) <= cap or len(set(v)) == 1 for v in got.values())
    flat = [set(v) for _, v in sorted(got.items())]
    assert all(max(a) < min(b) for a, b in zip(flat, flat[1:])), "no value in two batches, and in order"
    assert all(len(a) + len(b) > cap / 2 for a, b in zip(list(got.values()), list(got.values())[1:]))


HOT = f"(SELECT CASE WHEN event_id % 3 = 0 THEN 500 ELSE event_id END AS o, * FROM {EVENTS}) h"


@pytest.mark.parametrize("column, least", [(None, 8), ("event_type", 2), ("ts", 8), ("value", 8)])
@pytest.mark.parametrize("batch", [BatchRange("0", "999", True), BatchRange("500", "500", True), BatchRange("200", "500")])
def test_a_hot_value_is_read_over_several_connections(spark, column, least, batch):
    """A third of all rows on one value: pieces are disjoint, complete and about equally large."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE h AS SELECT * REPLACE (CASE WHEN event_id % 30 = 0 THEN NULL ELSE value END AS value) FROM {HOT}")
    options = {**OPTIONS, "dbtable": "h", **({"splitColumn": column} if column else {})}
    table = JdbcTable(DuckReader(spark, con), {**options, "numPartitions": "24"})
    offset = OffsetColumn.of(table.schema, "o")
    ends, hot = table._cuts(offset, batch, 24)
    assert set(hot) == {"500"}
    predicates = table.predicates(offset, batch, ends, table._hot_splits(offset, hot))
    sides = ">=" if batch.inclusive else ">"
    inside = f"o {sides} {batch.start} AND o <= {batch.end}"
    ids = [r for p in predicates for (r,) in con.execute(f"SELECT event_id FROM h WHERE {p}").fetchall()]
    assert sorted(ids) == [r for (r,) in con.execute(f"SELECT event_id FROM h WHERE {inside} ORDER BY 1").fetchall()]
    sizes = [con.execute(f"SELECT COUNT(*) FROM h WHERE {p}").fetchone()[0] for p in predicates if " = 500 " in p]
    assert len(sizes) >= least and sum(sizes) == con.execute("SELECT COUNT(*) FROM h WHERE o = 500").fetchone()[0]
    if least > 2:
        assert max(sizes) <= 3 * 1000 / 24
    rows = table.read(offset, batch)
    assert sorted(r.event_id for r in rows.collect()) == sorted(ids)


def test_a_hot_value_without_another_column_stays_whole(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE h AS SELECT 7 AS o FROM range(100)")
    table = JdbcTable(DuckReader(spark, con), {**OPTIONS, "dbtable": "h", "numPartitions": "4"})
    assert table.read(OffsetColumn.of(table.schema, "o"), BatchRange("7", "7", True)).count() == 100
    con.execute("CREATE TABLE e AS SELECT 7 AS o, 'same' AS s FROM range(100)")
    table = JdbcTable(DuckReader(spark, con), {**OPTIONS, "dbtable": "e", "numPartitions": "4"})
    assert table.read(OffsetColumn.of(table.schema, "o"), BatchRange("7", "7", True)).count() == 100


def test_capped_feed_over_jdbc(spark, folder):
    reader = DuckReader(spark, duckdb.connect())
    table = JdbcTable(reader, {**OPTIONS, "numPartitions": "3"})
    got = []
    feed = IncrementalFeed(
        spark, table, {"offset.field": "ts"}, f"{folder}/log", rows_per_batch=300
    )
    feed.run_available(lambda batch, _: got.append([r.event_id for r in batch.collect()]))
    assert max(map(len, got)) <= 300 and sorted(sum(got, [])) == list(range(1000))
    # Planning the cuts reads over all connections too: only the schema is taken from the whole.
    assert [q for q in reader.asked if "WHERE" not in q and "MIN(" not in q] == [
        f"SELECT * FROM {EVENTS}"
    ]
