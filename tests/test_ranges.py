from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.bounds import both_bounds, end_bound, fetch_bound, start_bound
from tidemark.operators.ranges import BatchRange, read_nothing, read_range, split_range
from tidemark.plans.progress import Span, batch_range, first_span, next_span


def column(data_type):
    return OffsetColumn.of(T.StructType([T.StructField("pos", data_type)]), "pos")


def holds(offset, batch, value):
    low, high = offset.parse(batch.start), offset.parse(batch.end)
    return (value >= low if batch.inclusive else value > low) and value <= high


def assert_partition(offset, batch, parts, values):
    split = split_range(offset, batch, parts)
    assert 1 <= len(split) <= max(parts, 1)
    assert (split[0].start, split[-1].end) == (batch.start, batch.end)
    for value in values:
        assert sum(holds(offset, p, value) for p in split) == holds(offset, batch, value)


@given(
    st.integers(-(2**63), 2**63 - 1),
    st.integers(-(2**63), 2**63 - 1),
    st.booleans(),
    st.integers(1, 20),
    st.lists(st.integers(-(2**63), 2**63 - 1)),
)
def test_whole_number_parts_cover_the_range_once(a, b, inclusive, parts, values):
    low, high = sorted((a, b))
    batch = BatchRange(str(low), str(high), inclusive)
    values = [*values, low, high, (low + high) // 2]
    assert_partition(column(T.LongType()), batch, parts, values)


@given(
    st.floats(-1e300, 1e300),
    st.floats(-1e300, 1e300),
    st.booleans(),
    st.integers(1, 20),
    st.lists(st.floats(-1e300, 1e300)),
)
def test_double_parts_cover_the_range_once(a, b, inclusive, parts, values):
    low, high = sorted((a, b))
    batch = BatchRange(repr(low), repr(high), inclusive)
    assert_partition(column(T.DoubleType()), batch, parts, [*values, low, high])


@given(st.dates(), st.dates(), st.booleans(), st.integers(1, 20), st.lists(st.dates()))
def test_date_parts_cover_the_range_once(a, b, inclusive, parts, values):
    low, high = sorted((a, b))
    batch = BatchRange(low.isoformat(), high.isoformat(), inclusive)
    assert_partition(column(T.DateType()), batch, parts, [*values, low, high])


@given(st.datetimes(), st.datetimes(), st.integers(1, 20), st.lists(st.datetimes()))
def test_timestamp_parts_cover_the_range_once(a, b, parts, values):
    low, high = sorted((a, b))
    c = column(T.TimestampNTZType())
    batch = BatchRange(c.format(low), c.format(high))
    assert_partition(c, batch, parts, [*values, low, high])


def test_decimal_parts():
    c = column(T.DecimalType(10, 2))
    values = [Decimal(i) / 100 for i in range(0, 1001)]
    assert_partition(c, BatchRange("0.00", "10.00", True), 7, values)


def test_strings_stay_whole():
    batch = BatchRange("a", "z", True)
    assert split_range(column(T.StringType()), batch, 8) == [batch]


def test_a_single_value_stays_whole():
    batch = BatchRange("5", "5", True)
    assert split_range(column(T.LongType()), batch, 8) == [batch]


@pytest.mark.parametrize("start, end", [(None, "1"), ("1", None), (None, None)])
def test_a_range_needs_both_bounds(start, end):
    with pytest.raises(ValueError, match="both bounds"):
        BatchRange(start, end)


# -- reads -----------------------------------------------------------------

CASES = {
    "int": (T.IntegerType(), [1, 2, 3, 4], "2", "3"),
    "double": (T.DoubleType(), [0.5, 2.0, 10.0, 12.5], "2", "10"),
    "decimal": (T.DecimalType(9, 2), [Decimal(1), Decimal(2), Decimal(30), Decimal(40)], "2", "30"),
    "date": (T.DateType(), [date(2020, 1, d) for d in (1, 2, 3, 4)], "2020-01-02", "2020-01-03"),
    "string": (T.StringType(), ["a", "b'c", "b'd", "c"], "b'c", "b'd"),
}


@pytest.mark.parametrize("case", CASES)
def test_inclusive_and_exclusive_reads(spark, case):
    data_type, values, low, high = CASES[case]
    df = spark.createDataFrame(
        [(v,) for v in [*values, None]], T.StructType([T.StructField("pos", data_type)])
    )
    c = OffsetColumn.of(df.schema, "pos")

    def read(inclusive):
        return [r.pos for r in read_range(df, c, BatchRange(low, high, inclusive)).collect()]

    assert read(True) == values[1:3]
    assert read(False) == values[2:3]


def test_read_nothing_scans_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    nothing = read_nothing(df)
    assert nothing.schema == df.schema and nothing.count() == 0
    assert "FileScan" not in nothing._jdf.queryExecution().executedPlan().toString()


def test_column_names_that_need_quotes(spark):
    df = spark.range(3).withColumnRenamed("id", "a.b`c")
    c = OffsetColumn.of(df.schema, "a.b`c")
    assert fetch_bound(both_bounds(df, c), c) == ("0", "2")
    assert read_range(df, c, BatchRange("0", "1")).count() == 1


# -- bounds ----------------------------------------------------------------


def test_bounds_with_and_without_a_limit(spark):
    df = spark.createDataFrame([(i,) for i in (5, 1, None, 9)], "pos int")
    c = OffsetColumn.of(df.schema, "pos")
    assert fetch_bound(start_bound(df, c), c) == ("1",)
    assert fetch_bound(start_bound(df, c, "4"), c) == ("1",)
    assert fetch_bound(start_bound(df, c, "0"), c) == (None,)
    assert fetch_bound(end_bound(df, c), c) == ("9",)
    assert fetch_bound(end_bound(df, c, "9"), c) == ("9",)
    assert fetch_bound(end_bound(df, c, "10"), c) == (None,)
    assert fetch_bound(both_bounds(df, c), c) == ("1", "9")


@pytest.mark.parametrize("rows", [[], [(None,)]])
def test_no_offsets_no_bounds(spark, rows):
    df = spark.createDataFrame(rows, "pos date")
    c = OffsetColumn.of(df.schema, "pos")
    assert fetch_bound(both_bounds(df, c), c) == (None, None)


def test_timestamp_bounds_keep_microseconds(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:07.179575' AS pos")
    c = OffsetColumn.of(df.schema, "pos")
    assert fetch_bound(end_bound(df, c), c) == ("2024-01-01 00:00:07.179575+00:00",)


# -- progress --------------------------------------------------------------


def test_first_span():
    assert first_span(None, None, None) is None
    assert first_span("3", None, None) is None
    assert first_span(None, "1", "9") == Span("1", "9")
    assert first_span("3", None, "9") == Span("3", "9")


def test_next_span_moves_only_up_and_by_value():
    c = column(T.LongType())
    assert next_span(c, Span("1", "9"), "10") == Span("9", "10")
    assert next_span(c, Span("1", "9"), "9") is None
    assert next_span(c, Span("1", "9"), "8") is None
    assert next_span(c, Span("1", "9"), None) is None


def test_strings_move_in_the_order_of_their_source():
    """In a case-blind collation 'B' comes after 'a', though its byte is smaller."""
    c = column(T.StringType())
    assert next_span(c, Span("A", "a"), "B") == Span("a", "B")
    assert next_span(c, Span("A", "a"), "a") is None


def test_equal_offsets_in_other_words_are_no_movement():
    c = column(T.DoubleType())
    assert next_span(c, Span("0.5", "2"), "2.0") is None


def test_batch_ranges():
    assert batch_range(None, Span("1", "9")) == BatchRange("1", "9", True)
    assert batch_range(Span("1", "9"), Span("9", "12")) == BatchRange("9", "12", False)
    with pytest.raises(ValueError, match="both bounds"):
        batch_range(None, Span(None, "9"))
