"""Tables whose schema changes between runs, and rows that come out of order."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.profile import offset_order_profile
from tidemark.plans.schema_history import SchemaChanged, check_evolution, widens
from tidemark.sources.tables import FrameTable
from tidemark.streaming.feed import IncrementalFeed

TYPES = "a byte, b short, c int, d long, e float, f double, g decimal(5,2), h decimal(20,4), i decimal(20,0), s string, t date"


@pytest.mark.parametrize(
    "old, holders",
    [("a", "abcdfghi"), ("c", "cdfhi"), ("d", "di"), ("e", "ef"), ("f", "f"), ("g", "gh"), ("h", "h"), ("s", "s"), ("t", "t")],
)
def test_types_that_hold_another(spark, old, holders):
    types = T.StructType.fromDDL(TYPES)
    assert "".join(f.name for f in types if widens(types[old].dataType, f.dataType)) == holders


def test_what_is_refused(spark):
    ddl = T.StructType.fromDDL
    check_evolution(ddl("a int, b string"), ddl("b string, c array<int>, a long"))
    with pytest.raises(SchemaChanged, match="gone"):
        check_evolution(ddl("a int, b string"), ddl("a int"))
    with pytest.raises(SchemaChanged, match="a: bigint to int"):
        check_evolution(ddl("a long"), ddl("a int"))


class Table:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.got = spark, folder, {}

    def run(self, rows, ddl, sink=None):
        frame = self.spark.createDataFrame(rows, ddl)
        self.feed = IncrementalFeed(self.spark, FrameTable(lambda: frame), {"offset.field": "o"}, f"{self.folder}/log")
        return self.feed.run_available(sink or (lambda batch, i: self.got.__setitem__(i, (batch.schema.simpleString(), sorted(map(tuple, batch.collect()))))))


def test_a_column_that_comes_and_a_type_that_grows(spark, folder):
    table = Table(spark, folder)
    table.run([(1, 10)], "o int, x int")
    table.run([(1, 10), (2, 20)], "o int, x int")
    table.run([(1, 10, None), (2, 20, None), (3, 2**40, "new")], "o long, x long, s string")
    assert table.got[2] == ("struct<o:bigint,x:bigint,s:string>", [(3, 2**40, "new")])
    noted = [tuple(r) for r in table.feed.log.schemas().orderBy("batch_id", "place").collect()]
    assert noted == [(0, "o", "int", 0), (0, "x", "int", 1), (2, "o", "bigint", 0), (2, "x", "bigint", 1), (2, "s", "string", 2)]
    for rows, ddl in (([(4, 1)], "o long, x long"), ([(4, 1, "s")], "o long, x int, s string")):
        with pytest.raises(SchemaChanged):
            table.run(rows, ddl)


def test_an_unfinished_batch_has_the_schema_it_was_planned_with(spark, folder):
    table = Table(spark, folder)
    table.run([(1, 10)], "o int, x int")

    def breaks(batch, _):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError):
        table.run([(1, 10), (2, 20)], "o int, x int", breaks)
    table.run([(1, "a", 10), (2, "b", 20), (3, "c", 2**40)], "o int, s string, x long")
    assert table.got[1] == ("struct<o:int,x:int>", [(2, 20)])
    assert table.got[2] == ("struct<o:int,s:string,x:bigint>", [(3, "c", 2**40)])


def test_a_log_from_before_schemas_were_kept(spark, folder):
    table = Table(spark, folder)
    table.run([(1, 10)], "o int, x int")
    for name in ("0", ".0.crc"):
        table.feed.log._fs.delete(table.feed.log._path(f"schemas/{name}"), False)
    table.run([(1,), (2,)], "o int")
    assert table.got[1] == ("struct<o:int>", [(2,)]) and table.feed.log.schema().names == ["o"]


# -- order ------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["long", "double", "string"])
def test_order_against_a_plain_sweep(spark, kind):
    rng = random.Random(len(kind))
    make = {"long": lambda: rng.randrange(50), "double": lambda: rng.choice([rng.random(), float("nan")]), "string": lambda: rng.choice("abcdéf")}[kind]
    rows = [(rng.randrange(30) if rng.random() < 0.95 else None, make() if rng.random() < 0.95 else None) for _ in range(600)]
    df = spark.createDataFrame(rows, f"at int, v {kind}").repartition(5)
    got = offset_order_profile(df, "v", "at").first()
    good = [(a, v) for a, v in rows if a is not None and v is not None and v == v]
    late = below = 0
    points = set()
    for a, v in good:
        before = [w for b, w in good if b < a]
        if before and v <= max(before):
            late, below = late + 1, below + (v < max(before))
            points.add(a)
    assert (got.field, got.n_rows, got.n_late, got.n_below, got.n_publications) == ("v", len(good), late, below, len(points))


def test_order_of_files(spark, folder):
    for part in ([1, 2, 3], [4, 5], [3, 6]):
        spark.createDataFrame([(v,) for v in part], "v int").coalesce(1).write.mode("append").parquet(folder)
    got = offset_order_profile(spark.read.parquet(folder), "v", F.col("_metadata.file_modification_time")).first()
    assert (got.n_rows, got.n_late, got.n_below, got.n_publications) == (7, 1, 1, 1)
    empty = spark.createDataFrame([], "at int, v int")
    assert tuple(offset_order_profile(empty, "v", "at").first()) == ("v", 0, 0, 0, 0)
