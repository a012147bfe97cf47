"""JDBC tables: the probe runs in the database, a batch is read over many connections."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.offset_column import (
    DATE,
    NUMBER,
    STRING,
    TIMESTAMP,
    OffsetColumn,
)
from tidemark.operators.batch_cuts import pack_runs, run_size
from tidemark.operators.bounds import END_OFFSET, START_OFFSET, fetch_bound
from tidemark.operators.ranges import BatchRange, read_range, split_range
from tidemark.plans.settings import source_options

_SPLIT_KEYS = frozenset({"partitioncolumn", "lowerbound", "upperbound", "numpartitions"})
#: Option that names the column over which a hot offset value is split.
SPLIT_COLUMN = "splitcolumn"
_PLACE_KEYS = frozenset({"url", "dbtable"})
_FETCH_ROWS = "10000"
#: Connections of a batch unless 'numPartitions' says otherwise.
CONNECTIONS = 8


class JdbcTable:
    """A JDBC table, with the options of Spark's own JDBC reader.

    ``numPartitions`` (8 unless given) splits each batch over the offset column, by row
    counts that the database tells in one query, strings included. An offset value that holds more rows than a
    connection should read is split a second time, over ``splitColumn``, or over the column with the most
    different values among its rows; only rows that are equal there too stay together. With ``partitionColumn``,
    ``lowerBound`` and ``upperBound`` the batch is split over that column instead, and the range filter is pushed down on top.
    """

    # The database compares strings in a collation of its own.
    strings_ordered_by_bytes = False

    def __init__(self, spark: SparkSession, options: Mapping[str, str]) -> None:
        self._spark = spark
        given = {key.lower(): value for key, value in source_options(options).items()}
        self._options = {k: v for k, v in source_options(options).items() if k.lower() != SPLIT_COLUMN}
        self._url = given.get("url")
        if not self._url:
            raise ValueError("Option 'url' is missing.")
        self._table = given.get("dbtable")
        if not self._table:
            raise ValueError("Option 'dbtable' is missing.")
        self._given = given

    # -- plain reads ---------------------------------------------------------

    def _load(self, options: Mapping[str, str]) -> DataFrame:
        return self._spark.read.format("jdbc").options(**options).load()

    def _unsplit_options(self) -> dict[str, str]:
        return {k: v for k, v in self._options.items() if k.lower() not in _SPLIT_KEYS}

    def frame(self) -> DataFrame:
        return self._load(self._unsplit_options())

    def pinned(self) -> JdbcTable:
        return self

    @cached_property
    def schema(self) -> T.StructType:
        return self.frame().schema

    # -- probe ---------------------------------------------------------------

    def bounds(
        self, offset: OffsetColumn, at_least: str | None = None
    ) -> tuple[str | None, str | None]:
        options = {k: v for k, v in self._unsplit_options().items() if k.lower() != "dbtable"}
        probe = self._load({**options, "query": self.probe_query(offset, at_least)})
        found = fetch_bound(probe, offset)
        return found if at_least is None else (None, *found)

    def probe_query(self, offset: OffsetColumn, at_least: str | None = None) -> str:
        """MIN and MAX as SQL: Spark does not push these aggregates into its V1 JDBC reader."""
        dialect = self._dialect
        name = dialect.quoteIdentifier(offset.name)
        most = f"MAX({name}) AS {END_OFFSET}"
        if at_least is None:
            return f"SELECT MIN({name}) AS {START_OFFSET}, {most} FROM {self._table}"
        bound = self._sql_literal(dialect, offset, at_least)
        return f"SELECT {most} FROM {self._table} WHERE {name} >= {bound}"

    @property
    def _dialect(self):
        return self._spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self._url)

    def _sql_literal(self, dialect, offset: OffsetColumn, text: str) -> str:
        """A literal as Spark's own dialect writes it, quotes escaped."""
        value = offset.parse(text)
        java = self._spark._jvm.java
        if offset.kind == NUMBER:
            return offset.format(value)
        if offset.kind == STRING:
            return dialect.compileValue(value)
        if offset.kind == DATE:
            return dialect.compileValue(java.sql.Date.valueOf(offset.format(value)))
        if offset.kind == TIMESTAMP:
            # The database holds wall-clock times in the JVM's zone, as Spark's reader takes them.
            micros = offset.to_point(text)
            stamp = java.sql.Timestamp(micros // 1_000_000 * 1000)
            stamp.setNanos(micros % 1_000_000 * 1000)
            return dialect.compileValue(stamp)
        return dialect.compileValue(java.sql.Timestamp.valueOf(_wall_clock(value)))

    # -- one batch -----------------------------------------------------------

    def read(self, offset: OffsetColumn, batch: BatchRange) -> DataFrame:
        options = {**_fetching(self._given), **self._options}
        if "partitioncolumn" not in self._given:
            options = {k: v for k, v in options.items() if k.lower() not in _SPLIT_KEYS}
            parts = int(self._given.get("numpartitions", CONNECTIONS))
            predicates = []
            if parts > 1:
                ends, hot = self._cuts(offset, batch, parts)
                predicates = self.predicates(offset, batch, ends, self._hot_splits(offset, hot))
            elif offset.kind == STRING:
                predicates = self.predicates(offset, batch, [batch.end])
            if len(predicates) > 1 or offset.kind == STRING:
                rows = self._spark.read.jdbc(
                    self._url,
                    self._table,
                    predicates=predicates,
                    properties={k: v for k, v in options.items() if k.lower() not in _PLACE_KEYS},
                )
                # Strings are compared by the database alone, whose order may not be Spark's.
                return rows if offset.kind == STRING else read_range(rows, offset, batch)
        elif offset.kind == STRING:
            (inside,) = self.predicates(offset, batch, [batch.end])
            options = {k: v for k, v in options.items() if k.lower() != "dbtable"}
            return self._load({**options, "dbtable": f"(SELECT * FROM {self._table} WHERE {inside}) in_range"})
        return read_range(self._load(options), offset, batch)

    def ends_query(self, offset: OffsetColumn, batch: BatchRange, parts: int) -> str:
        """Where to end ``parts`` sub-ranges of equally many rows, in the database's own order."""
        name = self._dialect.quoteIdentifier(offset.name)
        (inside,) = self.predicates(offset, batch, [batch.end])
        return (
            f"SELECT part, MAX({name}) AS {END_OFFSET} FROM (SELECT {name}, "
            f"NTILE({parts}) OVER (ORDER BY {name}) AS part FROM {self._table} WHERE {inside}) tiles GROUP BY part"
        )

    def _asked(self, query: str) -> DataFrame:
        options = {k: v for k, v in self._unsplit_options().items() if k.lower() != "dbtable"}
        return self._load({**options, "query": query})

    def _ends(self, offset: OffsetColumn, batch: BatchRange, parts: int) -> list[str]:
        return self._cuts(offset, batch, parts)[0]

    def _cuts(self, offset: OffsetColumn, batch: BatchRange, parts: int) -> tuple[list[str], dict[str, int]]:
        """Ends of sub-ranges, and the values that fill several tiles with the number of these."""
        rows = self._tiles(self.ends_query(offset, batch, parts), offset)
        tiles = Counter(end for end, _ in rows)
        # A value that fills several tiles ends one sub-range; what lies beyond belongs to the last.
        kept = [e for i, (e, n) in enumerate(tiles.items(), 1) if i < len(tiles) or n > 1]
        return [*(e for e in kept if e != batch.end), batch.end], {e: n for e, n in tiles.items() if n > 1}

    def _tiles(self, query: str, offset: OffsetColumn) -> list[tuple[str, int | None]]:
        """End and rows (if asked for) of each tile, in order."""
        tiles = self._asked(query)
        # Names come back in the case the database prefers.
        name = {c.lower(): c for c in tiles.columns}
        order = [c for c in ("part", "light") if c in name]
        count = tiles[name["n_rows"]].cast("long") if "n_rows" in name else F.lit(None)
        rows = tiles.select(*(tiles[name[c]].alias(c) for c in order), offset.carrier(tiles[name[END_OFFSET]]).alias("end"), count.alias("n")).collect()
        return [(offset.from_carrier(r["end"]), r["n"]) for r in sorted(rows, key=lambda r: [r[c] for c in order])]

    # -- one hot value ---------------------------------------------------------

    def _hot_splits(self, offset: OffsetColumn, hot: dict[str, int]) -> dict[str, list[str]]:
        """Conditions that split the rows of each hot value: disjoint, and true of every row in turn."""
        found = {}
        for value, parts in hot.items():
            column = self._split_column(offset, value)
            if column is not None:
                tiles = self._tiles(self.hot_query(offset, value, column, parts), column)
                ends = list(dict.fromkeys(end for end, _ in tiles))[:-1]
                found[value] = self._between(column, ends)
        return found

    def _split_column(self, offset: OffsetColumn, value: str) -> OffsetColumn | None:
        """The column to split a hot value over: the one named, or the one with the most values there."""
        if SPLIT_COLUMN in self._given:
            return OffsetColumn.of(self.schema, self._given[SPLIT_COLUMN], offset.time_zone)
        others = []
        for field in self.schema:
            try:
                others.append(OffsetColumn.of(T.StructType([field]), field.name, offset.time_zone))
            except ValueError:  # no order
                continue
        others = [c for c in others if c.name != offset.name]
        if not others:
            return None
        counts = self._asked(self.variety_query(offset, value, others)).first()
        best = max(range(len(others)), key=lambda i: counts[i] or 0)
        return others[best] if (counts[best] or 0) > 1 else None

    def _equals(self, offset: OffsetColumn, value: str) -> str:
        dialect = self._dialect
        return f"{dialect.quoteIdentifier(offset.name)} = {self._sql_literal(dialect, offset, value)}"

    def variety_query(self, offset: OffsetColumn, value: str, others: list[OffsetColumn]) -> str:
        """How many values other columns have where the offset is ``value``."""
        counts = (f"COUNT(DISTINCT {self._dialect.quoteIdentifier(c.name)}) AS c{i}" for i, c in enumerate(others))
        return f"SELECT {', '.join(counts)} FROM {self._table} WHERE {self._equals(offset, value)}"

    def hot_query(self, offset: OffsetColumn, value: str, column: OffsetColumn, parts: int) -> str:
        """Where to end ``parts`` pieces of equally many rows of one offset value, in the order of ``column``."""
        name = self._dialect.quoteIdentifier(column.name)
        return (
            f"SELECT part, MAX({name}) AS {END_OFFSET} FROM (SELECT {name}, NTILE({parts}) OVER (ORDER BY {name}) AS part "
            f"FROM {self._table} WHERE {self._equals(offset, value)} AND {name} IS NOT NULL) tiles GROUP BY part"
        )

    def _between(self, column: OffsetColumn, ends: list[str]) -> list[str]:
        """Pieces of all values of ``column``, NULL in the first; what comes beyond the ends is in the last."""
        dialect = self._dialect
        name = dialect.quoteIdentifier(column.name)
        cuts = [self._sql_literal(dialect, column, end) for end in ends]
        if not cuts:
            return []
        inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:])]
        return [f"({name} <= {cuts[0]} OR {name} IS NULL)", *inner, f"{name} > {cuts[-1]}"]

    # -- caps in the database's own order ----------------------------------------

    def ranked_query(self, offset: OffsetColumn, batch: BatchRange, unit: int) -> str:
        """Runs of neighbouring values of about ``unit`` rows: their ends and rows, counted and ordered by the database.

        A value of ``unit`` rows or more is a run of its own, and comes before the others that end in its stretch.
        """
        name = self._dialect.quoteIdentifier(offset.name)
        (inside,) = self.predicates(offset, batch, [batch.end])
        return (
            f"SELECT part, light, MAX({name}) AS {END_OFFSET}, SUM(n) AS n_rows FROM (SELECT {name}, n, "
            f"FLOOR((upto - 1) / {unit}.0) AS part, CASE WHEN n >= {unit} THEN 0 ELSE 1 END AS light FROM ("
            f"SELECT {name}, COUNT(*) AS n, SUM(COUNT(*)) OVER (ORDER BY {name} ROWS UNBOUNDED PRECEDING) AS upto "
            f"FROM {self._table} WHERE {inside} GROUP BY {name}) counted) runs GROUP BY part, light"
        )

    def ranked_ends(self, offset: OffsetColumn, batch: BatchRange, rows: int) -> list[str]:
        """End offsets of batches of at most ``rows`` rows, values of more rows alone, in the database's order."""
        unit = run_size(rows)
        runs = self._tiles(self.ranked_query(offset, batch, unit), offset)
        return pack_runs([(n, end) for end, n in runs], batch.end, rows)

    def predicates(
        self, offset: OffsetColumn, batch: BatchRange, ends: list[str] | None = None, hot: Mapping[str, list[str]] | None = None
    ) -> list[str]:
        """One SQL condition per connection: disjoint sub-ranges that cover ``batch``.

        They end at ``ends``; without, they are equally wide. ``hot`` tells how to split the rows of some of the ends.
        """
        dialect = self._dialect
        name = dialect.quoteIdentifier(offset.name)
        if ends is None:
            split = split_range(offset, batch, int(self._given.get("numpartitions", "1")))
        else:
            starts = [batch.start, *ends[:-1]]
            split = [BatchRange(a, b, batch.inclusive and i == 0) for i, (a, b) in enumerate(zip(starts, ends))]
        out = []
        for part in split:
            start = f"{name} {'>=' if part.inclusive else '>'} {self._sql_literal(dialect, offset, part.start)}"
            end = self._sql_literal(dialect, offset, part.end)
            pieces = (hot or {}).get(part.end)
            if not pieces:
                out.append(f"{start} AND {name} <= {end}")
                continue
            if part.start != part.end:
                out.append(f"{start} AND {name} < {end}")
            out += [f"{name} = {end} AND {piece}" for piece in pieces]
        return out


def _fetching(given: Mapping[str, str]) -> dict[str, str]:
    # Some drivers fetch ten rows per round trip unless told otherwise.
    return {} if "fetchsize" in given else {"fetchsize": _FETCH_ROWS}


def _wall_clock(value: datetime) -> str:
    return value.strftime("%Y-%m-%d %H:%M:%S.%f")
