"""Database tables for the stream reader, through any Python DB-API 2.0 driver."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Mapping
from typing import Any, NamedTuple

from tidemark.functions.offset_column import OffsetColumn
from tidemark.operators.ranges import BatchRange, split_range

# How each DB-API parameter style marks one positional parameter.
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s", "numeric": ":{}", "named": ":p{}"}

_CONNECT_PREFIX = "dbapi."
_CONNECT_JSON = "dbapi.connect"
_FETCH_ROWS = 10_000


class Slice(NamedTuple):
    """Part of one batch, read over one connection.

    ``above`` and ``upto`` bound the split column where the user named one; the first
    and the last slice are open, and the first one takes the NULLs.
    """

    start: str
    end: str
    inclusive: bool
    above: int | None = None
    upto: int | None = None


class DbApiTable:
    """``dbtable`` in a database that the driver module ``dbapi`` connects to.

    Options ``dbapi.<name>`` become arguments of the module's ``connect``; Spark lower-cases their
    names, and they are texts. ``dbapi.connect`` takes a JSON object instead, whose names and types
    (numbers, booleans, camel case) arrive as they are. Values are
    bound as parameters and the column name is quoted, so no user text is run as SQL
    except ``dbtable`` itself, which may be a parenthesised query with an alias.

    ``numPartitions`` splits a batch evenly over the offset column; with
    ``partitionColumn``, ``lowerBound`` and ``upperBound`` over that whole-number column,
    for tables where one offset value holds very many rows.
    """

    def __init__(self, options: Mapping[str, str], offset: OffsetColumn, columns: list[str]):
        self._module = options["dbapi"]
        self._table = options["dbtable"]
        self._quote = options.get("identifierquote", '"')
        self._parts = int(options.get("numpartitions", "1"))
        self._connect_args = {
            k[len(_CONNECT_PREFIX) :]: v
            for k, v in options.items()
            if k.startswith(_CONNECT_PREFIX) and k != _CONNECT_JSON
        }
        self._connect_args |= json.loads(options.get(_CONNECT_JSON, "{}"))
        self._split_column = options.get("partitioncolumn")
        if self._split_column:
            self._split_bounds = int(options["lowerbound"]), int(options["upperbound"])
        self._offset = offset
        self._columns = columns

    def _quoted(self, name: str) -> str:
        return self._quote + name.replace(self._quote, self._quote * 2) + self._quote

    def _run(self, sql: str, *values: Any) -> Iterator[list[tuple]]:
        """Rows of ``sql``, some thousand at a time; its ``{}`` places take ``values`` as parameters."""
        driver = importlib.import_module(self._module)
        mark = _MARKS[driver.paramstyle]
        marks = [mark.format(i) for i in range(1, len(values) + 1)]
        if mark == "%s" and values:
            sql = sql.replace("%", "%%")  # elsewhere the sign stands for itself
        bound: Any = list(values)
        if driver.paramstyle == "named":
            bound = {f"p{i}": v for i, v in enumerate(values, 1)}
        connection = driver.connect(**self._connect_args)
        try:
            cursor = connection.cursor()
            # Without parameters some drivers leave the text alone, so none are passed.
            cursor.execute(sql.format(*marks), *([bound] if values else []))
            while rows := cursor.fetchmany(_FETCH_ROWS):
                yield rows
        finally:
            connection.close()

    def bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        name = _no_marks(self._quoted(self._offset.name))
        table = _no_marks(self._table)
        if at_least is None:
            rows = self._run(f"SELECT MIN({name}), MAX({name}) FROM {table}")
            ((least, most),) = next(rows)
        else:
            floor = self._offset.parse(at_least)
            rows = self._run(f"SELECT MAX({name}) FROM {table} WHERE {name} >= {{}}", floor)
            least, ((most,),) = None, next(rows)
        rows.close()
        return self._text(least), self._text(most)

    def _text(self, value: Any) -> str | None:
        # By way of text, since drivers differ in the Python types they hand over.
        return None if value is None else self._offset.format(self._offset.parse(str(value)))

    def slices(self, start: str, end: str, inclusive: bool) -> list[Slice]:
        if not self._split_column:
            parts = split_range(self._offset, BatchRange(start, end, inclusive), self._parts)
            return [Slice(p.start, p.end, p.inclusive) for p in parts]
        low, high = self._split_bounds
        cuts = sorted({low + (high - low) * i // self._parts for i in range(1, self._parts)})
        edges = zip([None, *cuts], [*cuts, None])
        return [Slice(start, end, inclusive, above, upto) for above, upto in edges]

    def read(self, piece: Slice) -> Iterator[list[tuple]]:
        name = _no_marks(self._quoted(self._offset.name))
        columns = _no_marks(", ".join(self._quoted(c) for c in self._columns))
        above = ">=" if piece.inclusive else ">"
        sql = f"SELECT {columns} FROM {_no_marks(self._table)} "
        sql += f"WHERE {name} {above} {{}} AND {name} <= {{}}"
        values = [self._offset.parse(piece.start), self._offset.parse(piece.end)]
        if piece.above is not None or piece.upto is not None:
            split = _no_marks(self._quoted(self._split_column))
            if piece.above is None:
                sql += f" AND ({split} <= {{}} OR {split} IS NULL)"
                values.append(piece.upto)
            else:
                sql += f" AND {split} > {{}}"
                values.append(piece.above)
                if piece.upto is not None:
                    sql += f" AND {split} <= {{}}"
                    values.append(piece.upto)
        return self._run(sql, *values)


def _no_marks(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")
