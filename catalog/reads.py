"""Bounds, ranges, cuts and profiles over batch tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.tables import DERIVED, TRACKED, halves
from tidemark.functions.offset_column import OffsetColumn, offset_kind
from tidemark.operators.batch_cuts import batch_ends
from tidemark.operators.bounds import both_bounds, end_bound, fetch_bound, start_bound
from tidemark.operators.profile import offset_profile
from tidemark.operators.ranges import (
    BatchRange,
    range_predicate,
    read_range,
    split_range,
    start_predicate,
)
from tidemark.operators.round_trip import round_trips
from tidemark.plans.progress import Span, batch_range, first_span, next_span
from tidemark.streaming.datasource import TidemarkSource

_FAMILIES = ("number", "double", "date", "string", "ts")
_SPLIT_PARTS = 8


# -- bounds ---------------------------------------------------------------


def _start(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    df = TRACKED[kind].frame(spark, sf)
    return start_bound(df, TRACKED[kind].offset(df))


def _end(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    df = TRACKED[kind].frame(spark, sf)
    return end_bound(df, TRACKED[kind].offset(df))


def _start_upto(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    table = halves(spark, sf, kind)
    return start_bound(table.df, table.offset, table.lower.end)


def _end_from(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    table = halves(spark, sf, kind)
    return end_bound(table.df, table.offset, table.lower.end)


def _end_beyond(spark: SparkSession, sf: str) -> DataFrame:
    """Nothing lies at or above the value after the last: the bound is NULL."""
    df = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(df)
    (last,) = fetch_bound(end_bound(df, offset), offset)
    return end_bound(df, offset, str(int(last) + 1))


def _first_range(spark: SparkSession, sf: str) -> DataFrame:
    df = TRACKED["number"].frame(spark, sf)
    return both_bounds(df, TRACKED["number"].offset(df))


# -- ranges ---------------------------------------------------------------


def _range_lower(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    table = halves(spark, sf, kind)
    return read_range(table.df, table.offset, table.lower)


def _range_upper(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    table = halves(spark, sf, kind)
    return read_range(table.df, table.offset, table.upper)


def _range_empty(spark: SparkSession, sf: str) -> DataFrame:
    """From the last offset, excluded, to itself: what a table without news has to give."""
    df = TRACKED["number"].frame(spark, sf)
    offset = TRACKED["number"].offset(df)
    (last,) = fetch_bound(end_bound(df, offset), offset)
    return read_range(df, offset, BatchRange(last, last))


def _first_range_from_param(spark: SparkSession, sf: str) -> DataFrame:
    """A given start replaces the minimum and is itself included."""
    table = halves(spark, sf, "number")
    (most,) = fetch_bound(end_bound(table.df, table.offset, table.lower.end), table.offset)
    span = first_span(table.lower.end, None, most)
    return read_range(table.df, table.offset, batch_range(None, span))


def _next_range(spark: SparkSession, sf: str) -> DataFrame:
    """The span after the lower half: its start is the previous end, excluded."""
    table = halves(spark, sf, "number")
    previous = Span(table.lower.start, table.lower.end)
    (most,) = fetch_bound(end_bound(table.df, table.offset, previous.end), table.offset)
    span = next_span(table.offset, previous, most)
    return read_range(table.df, table.offset, batch_range(previous, span))


def _range_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with the sub-range that delivers it: each is read as a batch of its own."""
    tracked = TRACKED["ties"]
    source = tracked.source(spark, sf)
    offset = OffsetColumn.of(source.schema, tracked.field)
    whole = BatchRange(*source.bounds(offset), True)
    parts = split_range(offset, whole, _SPLIT_PARTS)
    reads = (source.read(offset, p).withColumn("part", F.lit(i)) for i, p in enumerate(parts))
    return reduce(DataFrame.unionAll, reads)


def _range_covers(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Both halves side by side: inclusive, then exclusive, with no row twice or missing."""
    table = halves(spark, sf, kind)
    side = F.when(
        start_predicate(table.offset, table.upper.start, inclusive=False), "later"
    ).otherwise("first")
    return table.df.groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(table.offset.column()).alias("start_offset"),
        F.max(table.offset.column()).alias("end_offset"),
    )


# -- columns --------------------------------------------------------------


def _offset_profile(spark: SparkSession, sf: str) -> DataFrame:
    measured = F.when(F.col("event_type") == "error", F.lit(float("nan")))
    measured = measured.when(F.col("event_type") != "click", F.col("value"))
    events = TRACKED["number"].frame(spark, sf).withColumn("measured", measured)
    lineitem = TRACKED["ties"].frame(spark, sf)
    named = offset_profile(events, "event_id", "ts", "event_type")
    # Texts of doubles differ between engines: their bounds are compared as numbers.
    bounds = {c: F.col(c).cast("double").cast("decimal(18,6)").cast("string") for c in ("start_offset", "end_offset")}
    return named.unionAll(offset_profile(events, "measured").withColumns(bounds)).unionAll(
        offset_profile(lineitem, "l_orderkey")
    )


def _offset_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored offset finds the rows it came from: text, value and literal of each family.

    All distinct values are carried to a task as a probe carries them, written as text, parsed and
    written again there; those that a join on the value does not find again are lost. The bounds that
    a run meets then serve as literals that count their rows.
    """

    def one(kind: str) -> DataFrame:
        tracked = TRACKED[kind]
        df = tracked.frame(spark, sf)
        offset = OffsetColumn.of(df.schema, tracked.field)
        c = offset.column()
        # NaN is no offset.
        values = df.groupBy(offset.orderable().alias("value")).agg(F.count(c).alias("n"))
        trips = round_trips(values.select("value").where(F.col("value").isNotNull()), offset)
        lost = F.col("value").isNotNull() & F.col("parsed").isNull()
        whole = values.join(trips, F.col("value") == F.col("parsed"), "left").agg(
            F.sum("n").alias("n_values"), F.count_if(lost).alias("n_changed")
        )
        # What a run meets: the bounds, and the ends of batches in between.
        ends = BatchRange(*fetch_bound(both_bounds(df, offset), offset), True)
        texts = [ends.start, *batch_ends(lambda b: read_range(df, offset, b), offset, ends, max(df.count() // 20, 1))]
        again = {offset.format(offset.parse(t)) for t in texts}
        equal = [F.count_if(c == offset.literal(t)).alias(f"n{i}") for i, t in enumerate(sorted(again))]
        unmet = reduce(lambda a, b: a + b, (F.when(F.col(f"n{i}") == 0, 1).otherwise(0) for i in range(len(again))))
        n_lost = F.col("n_changed") + unmet + F.lit(len(again ^ set(texts)))
        return whole.crossJoin(df.agg(*equal)).select(
            F.lit(offset.kind).alias("kind"),
            F.lit(offset.name).alias("field"),
            F.coalesce("n_values", F.lit(0)).alias("n_values"),
            n_lost.cast("long").alias("n_lost"),
        )

    return reduce(DataFrame.unionAll, map(one, (*_FAMILIES, *DERIVED)))


def _per_column(df: DataFrame, **described: dict[str, str]) -> DataFrame:
    """One row per column: what is known of it, and how many values the table holds."""
    columns = list(next(iter(described.values())))
    rows = [
        F.struct(
            F.lit(c).alias("field"),
            *(F.lit(texts[c]).alias(name) for name, texts in described.items()),
            F.count(c).alias("n_values"),
        )
        for c in columns
    ]
    return df.agg(F.array(rows).alias("rows")).select(F.inline("rows"))


def _source_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The schema the stream source finds, against the values Spark reads."""
    path = f"{sf}/events.parquet"
    schema = TidemarkSource({"path": path, "offset.field": "ts"}).schema()
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return _per_column(spark.read.parquet(path), type=types)


def _offset_kind(spark: SparkSession, sf: str) -> DataFrame:
    """The offset family of every column."""
    df = TRACKED["ties"].frame(spark, sf)
    return _per_column(df, kind={f.name: offset_kind(f.dataType) for f in df.schema.fields})


# -- registry -------------------------------------------------------------

QUERIES = {
    "end_beyond": _end_beyond,
    "first_range": _first_range,
    "first_range_from_param": _first_range_from_param,
    "next_range": _next_range,
    "range_empty": _range_empty,
    "range_split": _range_split,
    "range_ties": partial(_range_upper, kind="ties"),
    "source_schema": _source_schema,
    "offset_kind": _offset_kind,
    "offset_profile": _offset_profile,
    "offset_roundtrip": _offset_roundtrip,
}

_EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}
_LINEITEM_KINDS = {
    "l_orderkey": "number",
    "l_partkey": "number",
    "l_suppkey": "number",
    "l_linenumber": "number",
    "l_quantity": "number",
    "l_extendedprice": "number",
    "l_discount": "number",
    "l_tax": "number",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

SQL = {
    "end_beyond": (
        "SELECT MAX(event_id) AS end_offset FROM events "
        "WHERE event_id >= (SELECT MAX(event_id) + 1 FROM events)"
    ),
    "first_range": (
        "SELECT MIN(event_id) AS start_offset, MAX(event_id) AS end_offset FROM events"
    ),
    "first_range_from_param": (
        f"WITH {TRACKED['number'].sql_bounds} "
        "SELECT * FROM events WHERE event_id >= (SELECT mid FROM m)"
    ),
    "next_range": (
        f"WITH {TRACKED['number'].sql_bounds} "
        "SELECT * FROM events WHERE event_id > (SELECT mid FROM m)"
    ),
    "range_empty": "SELECT * FROM events WHERE event_id > (SELECT MAX(event_id) FROM events)",
    "range_split": (
        "WITH b AS (SELECT MIN(l_orderkey) AS lo, MAX(l_orderkey) AS hi FROM lineitem), "
        "parts AS (SELECT i AS part, lo + (hi - lo) * i // 8 AS above, "
        "lo + (hi - lo) * (i + 1) // 8 AS upto FROM b, range(8) r(i)) "
        "SELECT lineitem.*, CAST(part AS INTEGER) AS part FROM lineitem JOIN parts "
        "ON l_orderkey <= upto AND (l_orderkey > above OR (part = 0 AND l_orderkey = above))"
    ),
    "range_ties": (
        f"WITH {TRACKED['ties'].sql_bounds} "
        "SELECT * FROM lineitem WHERE l_orderkey > (SELECT mid FROM m)"
    ),
    "source_schema": " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{t}' AS type, COUNT({c}) AS n_values FROM events"
        for c, t in _EVENT_TYPES.items()
    ),
    "offset_kind": " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{k}' AS kind, COUNT({c}) AS n_values FROM lineitem"
        for c, k in _LINEITEM_KINDS.items()
    ),
    "offset_profile": " UNION ALL ".join(
        f"SELECT '{field}' AS field, '{kind}' AS kind, COUNT(*) AS n_rows, "
        f"COUNT(*) - COUNT({field}) AS n_nulls, CAST(0 AS BIGINT) AS n_nans, "
        f"COUNT(DISTINCT {field}) AS n_distinct, "
        f"(SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {field}) g) AS max_ties, "
        f"CAST(MIN({field}) AS VARCHAR) AS start_offset, "
        f"CAST(MAX({field}) AS VARCHAR) AS end_offset FROM {table}"
        for table, field, kind in (
            ("events", "event_id", "number"),
            ("events", "ts", "timestamp_ntz"),
            ("events", "event_type", "string"),
            ("lineitem", "l_orderkey", "number"),
        )
    )
    + " UNION ALL SELECT 'measured', 'number', COUNT(*), COUNT(*) FILTER (event_type = 'click'), "
    "COUNT(*) FILTER (event_type = 'error'), "
    "COUNT(DISTINCT value) FILTER (event_type NOT IN ('click', 'error')), "
    "(SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM events "
    "WHERE event_type NOT IN ('click', 'error') GROUP BY value) g), "
    "CAST(CAST(MIN(value) FILTER (event_type NOT IN ('click', 'error')) AS DECIMAL(18,6)) AS VARCHAR), "
    "CAST(CAST(MAX(value) FILTER (event_type NOT IN ('click', 'error')) AS DECIMAL(18,6)) AS VARCHAR) "
    "FROM events",
    "offset_roundtrip": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{TRACKED[family].field}' AS field, "
        f"COUNT({TRACKED[family].field}) AS n_values, CAST(0 AS BIGINT) AS n_lost "
        f"FROM {TRACKED[family].sql_table}"
        for family, kind in (
            ("number", "number"),
            ("double", "number"),
            ("date", "date"),
            ("string", "string"),
            ("ts", "timestamp_ntz"),
            *((family, "number") for family in DERIVED),
        )
    ),
}

for _family in (*_FAMILIES, *DERIVED):
    _tracked = TRACKED[_family]
    _f, _t, _with = _tracked.field, _tracked.sql_table, f"WITH {_tracked.sql_bounds}"
    QUERIES |= {
        f"start_{_family}": partial(_start, kind=_family),
        f"end_{_family}": partial(_end, kind=_family),
        f"start_{_family}_upto": partial(_start_upto, kind=_family),
        f"end_{_family}_from": partial(_end_from, kind=_family),
        f"range_{_family}_incl": partial(_range_lower, kind=_family),
        f"range_{_family}_excl": partial(_range_upper, kind=_family),
        f"range_{_family}_covers": partial(_range_covers, kind=_family),
    }
    SQL |= {
        f"start_{_family}": f"SELECT MIN({_f}) AS start_offset FROM {_t}",
        f"end_{_family}": f"SELECT MAX({_f}) AS end_offset FROM {_t}",
        f"start_{_family}_upto": (
            f"{_with} SELECT MIN({_f}) AS start_offset FROM {_t} "
            f"WHERE {_f} <= (SELECT mid FROM m)"
        ),
        f"end_{_family}_from": (
            f"{_with} SELECT MAX({_f}) AS end_offset FROM {_t} WHERE {_f} >= (SELECT mid FROM m)"
        ),
        f"range_{_family}_incl": (
            f"{_with} SELECT * FROM {_t} "
            f"WHERE {_f} >= (SELECT lo FROM m) AND {_f} <= (SELECT mid FROM m)"
        ),
        f"range_{_family}_excl": (
            f"{_with} SELECT * FROM {_t} "
            f"WHERE {_f} > (SELECT mid FROM m) AND {_f} <= (SELECT hi FROM m)"
        ),
        f"range_{_family}_covers": (
            f"{_with} SELECT CASE WHEN {_f} > (SELECT mid FROM m) THEN 'later' ELSE 'first' END "
            f"AS side, COUNT(*) AS n_rows, MIN({_f}) AS start_offset, MAX({_f}) AS end_offset "
            f"FROM {_t} GROUP BY 1"
        ),
    }
