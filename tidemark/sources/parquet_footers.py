"""Parquet for the stream reader: bounds and scan pieces from file footers.

The stream reader has no SparkSession, so it lists and reads Parquet with Arrow.
Footers are read once per file, in parallel; column data is read only by tasks.
"""

from __future__ import annotations

import math

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import chain
from typing import Any, NamedTuple
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import types as T

from tidemark.functions.offset_column import STRING, TIMESTAMP, OffsetColumn
from tidemark.sources.bounds_index import column_folder, part_names

# Logs that say which files of a folder belong to the table.
_TABLE_LOGS = ("_spark_metadata", "_delta_log", ".hoodie")

# The types Spark reads unsigned numbers as.
_UNSIGNED = {
    pa.uint8(): pa.int16(),
    pa.uint16(): pa.int32(),
    pa.uint32(): pa.int64(),
    pa.uint64(): pa.decimal128(20, 0),
}

# Fixed value: the folder name that stands for NULL.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

_FOOTER_THREADS = 32
_BATCH_ROWS = 32_768
_BATCH_BYTES = 16 * 1024 * 1024
_SMALLEST_TASK = 4 * 1024 * 1024
_LARGEST_TASK = 128 * 1024 * 1024
_TASKS_PER_CORE = 2


class RowGroup(NamedTuple):
    """What planning needs of one row group; ``complete`` if its bounds speak for every row.

    An index tells blocks instead of row groups: ``(start, length)`` in bytes of the file.
    """

    path: str
    index: int | tuple[int, int]
    least: Any
    most: Any
    rows: int
    size: int
    complete: bool


class FileKey(NamedTuple):
    """A file as long as nobody rewrites it."""

    path: str
    size: int
    modified: int | None


class Piece(NamedTuple):
    """Row groups of one file, read by one task; ``whole`` if every row is wanted."""

    path: str
    groups: list[int | tuple[int, int]]
    whole: bool


def open_location(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; ``s3a`` is Hadoop's name for ``s3``."""
    uri = "s3" + uri[3:] if uri.startswith("s3a:") else uri
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def list_files(system: fs.FileSystem, root: str) -> list[fs.FileInfo]:
    """The data files of a folder, or the file itself; hidden names are left out as Spark does."""
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return [f for f in found if f.is_file and f.size and not _hidden(_inner(root, f.path))]


def _inner(root: str, path: str) -> list[str]:
    """The names below ``root`` that lead to a file, its own last."""
    return path[len(root) :].strip("/").split("/")


def _hidden(names: list[str]) -> bool:
    return any(name.startswith((".", "_")) and "=" not in name for name in names)


def check_table(uri: str) -> None:
    """Refuse a folder whose files count only as far as a log in it says."""
    system, root = open_location(uri)
    logs = [f"{root.rstrip('/')}/{name}" for name in _TABLE_LOGS]
    if any(found.type != fs.FileType.NotFound for found in system.get_file_info(logs)):
        raise ValueError(
            f"The files of {uri} count only as far as its own log says: "
            "follow it with an IncrementalFeed over the reader that knows the log."
        )


def table_shape(uri: str) -> tuple[pa.Schema, set[str]]:
    """The columns of the files, with Spark's types, and the names of ``key=value`` folders.

    The types of the latter are for Spark to tell.
    """
    check_table(uri)
    system, root = open_location(uri)
    files = sorted(f.path for f in list_files(system, root))
    if not files:
        raise ValueError(f"{uri} has no Parquet files, so its schema is unknown.")
    with system.open_input_file(files[0]) as source:
        footer = pq.read_metadata(source)
    names = (name.partition("=") for path in files for name in _inner(root, path)[:-1])
    return _as_spark_reads(footer), {key for key, mark, _ in names if mark}


def _as_spark_reads(footer: pq.FileMetaData) -> pa.Schema:
    """The columns of a file with the types Spark's own reader gives them."""
    leaves = [footer.schema.column(i) for i in range(footer.num_columns)]
    # INT96 timestamps are instants, though Arrow has them zoneless.
    instants = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}

    def read_as(field: pa.Field) -> pa.DataType:
        if field.name in instants:
            return pa.timestamp("us", "UTC")
        if pa.types.is_dictionary(field.type):
            return field.type.value_type
        return _UNSIGNED.get(field.type, field.type)

    return pa.schema([pa.field(f.name, read_as(f)) for f in footer.schema.to_arrow_schema()])


def _folder_values(root: str, path: str) -> dict[str, str]:
    pairs = (name.partition("=") for name in _inner(root, path)[:-1])
    return {key: unquote(value) for key, mark, value in pairs if mark and value != _NULL_FOLDER}


class FooterIndex:
    """Offset bounds per row group of a folder, kept up to date with its files."""

    def __init__(self, uri: str, offset: OffsetColumn) -> None:
        self._fs, self._root = open_location(uri)
        self._offset = offset
        self._floating = isinstance(offset.data_type, (T.FloatType, T.DoubleType))
        self._groups_of: dict[FileKey, list[RowGroup]] = {}
        self.loaded = False

    def refresh(self) -> None:
        """Read the footers of new files and drop the files that are gone."""
        listed = self._list()
        fresh = sorted(listed - self._groups_of.keys())
        kept = {key: groups for key, groups in self._groups_of.items() if key in listed}
        with ThreadPoolExecutor(_FOOTER_THREADS) as pool:
            kept.update(zip(fresh, pool.map(self._footer, (key.path for key in fresh))))
        self._groups_of = kept
        self.loaded = True

    def forget(self, end: str) -> None:
        """Drop the row groups a stream has left behind for good."""
        passed = self._offset.parse(end)
        for key, groups in self._groups_of.items():
            self._groups_of[key] = [g for g in groups if g.most > passed]

    @property
    def _groups(self) -> Iterator[RowGroup]:
        return chain.from_iterable(self._groups_of.values())

    def _list(self) -> set[FileKey]:
        files = list_files(self._fs, self._root)
        return {FileKey(f.path, f.size, f.mtime_ns) for f in files}

    def _footer(self, path: str) -> list[RowGroup]:
        with self._fs.open_input_file(path) as source:
            footer = pq.read_metadata(source)
        names = [footer.schema.column(i).path for i in range(footer.num_columns)]
        if self._offset.name not in names:
            raise ValueError(f"{path} has no column '{self._offset.name}'.")
        column = names.index(self._offset.name)
        groups = []
        for i in range(footer.num_row_groups):
            group = footer.row_group(i)
            stats = group.column(column).statistics
            if stats is not None and stats.has_null_count and stats.null_count == group.num_rows:
                continue
            if group.num_rows == 0:
                continue
            if stats is None or not stats.has_min_max:
                raise ValueError(
                    f"{path} has no statistics for '{self._offset.name}' (INT96 timestamps never "
                    "have any): follow this table with an IncrementalFeed instead."
                )
            if _nan(stats.min) or _nan(stats.max):  # Spark's writer counts NaN
                found = self._finite_bounds(path, i)
                if found is None:
                    continue  # nothing but NaN and NULL, which are never delivered
                least, most = found
            else:
                least, most = self._value(stats.min), self._value(stats.max)
            # A missing NULL count may hide NULLs, and statistics pass over NaN.
            complete = stats.has_null_count and stats.null_count == 0 and not self._floating
            size = group.total_byte_size
            groups.append(RowGroup(path, i, least, most, group.num_rows, size, complete))
        return groups

    def _finite_bounds(self, path: str, group: int) -> tuple[Any, Any] | None:
        """The bounds of a row group whose statistics NaN has taken over, from its column."""
        with self._fs.open_input_file(path) as source:
            column = pq.ParquetFile(source).read_row_group(group, [self._offset.name])[0]
        bounds = pc.min_max(pc.filter(column, pc.invert(pc.is_nan(column)))).as_py()
        return None if bounds["min"] is None else (self._value(bounds["min"]), self._value(bounds["max"]))

    def _value(self, value: Any) -> Any:
        return self._offset.parse(self._offset.format(value))

    # -- bounds --------------------------------------------------------------

    def bounds(self, at_least: str | None) -> tuple[str | None, str | None]:
        """``(MIN, MAX)`` of the table, or ``(None, MAX)`` of the rows from ``at_least`` on."""
        most = self._extreme(largest=True)
        if most is None:
            return None, None
        if at_least is not None:
            reached = most >= self._offset.parse(at_least)
            return None, self._offset.format(most) if reached else None
        return self._offset.format(self._extreme(largest=False)), self._offset.format(most)

    def _extreme(self, largest: bool) -> Any:
        """The exact MIN or MAX. Writers may shorten string statistics, so a string is
        looked up in the few row groups that can hold it."""
        if self._offset.kind != STRING:
            if largest:
                return max((g.most for g in self._groups), default=None)
            return min((g.least for g in self._groups), default=None)
        best = None
        order = sorted(self._groups, key=lambda g: g.most if largest else g.least, reverse=largest)
        for group in order:
            edge = group.most if largest else group.least
            if best is not None and (edge <= best if largest else edge >= best):
                break
            found = self._read_extreme(group, largest)
            if best is None or (found > best if largest else found < best):
                best = found
        return best

    def _read_extreme(self, group: RowGroup, largest: bool) -> str:
        with self._fs.open_input_file(group.path) as source:
            column = pq.ParquetFile(source).read_row_group(group.index, [self._offset.name])[0]
        values = column.drop_null().to_pylist()
        return max(values) if largest else min(values)

    def end_after(self, rows: int, floor: str | None) -> str | None:
        """The offset by which about ``rows`` rows lie above ``floor``, if row groups tell.

        Only a proposal for where to end a batch: ends are inclusive, so ties stay together,
        and what lies beyond is left to the next batch.
        """
        passed = None if floor is None else self._offset.parse(floor)
        ahead = sorted(
            (g.most, g.rows) for g in self._groups if passed is None or g.most > passed
        )
        seen = 0
        for most, count in ahead:
            seen += count
            if seen >= rows:
                return self._offset.format(most)
        return None

    # -- scan ----------------------------------------------------------------

    def pieces(
        self, start: str, end: str, inclusive: bool, size: int | None = None, cores: int = 1
    ) -> list[list[Piece]]:
        """The row groups that can hold the range, packed into tasks of about ``size`` bytes."""
        low, high = self._offset.parse(start), self._offset.parse(end)
        wanted = [
            g for g in self._groups
            if g.least <= high and (g.most > low or (inclusive and g.most == low))
        ]
        if size is None:
            size = _task_size(sum(g.size for g in wanted), cores)
        tasks: list[list[Piece]] = []
        filled = size
        for group in wanted:
            if filled >= size:
                tasks.append([])
                filled = 0
            above = group.least >= low if inclusive else group.least > low
            whole = group.complete and above and group.most <= high
            last = tasks[-1][-1] if tasks[-1] else None
            if last and (last.path, last.whole) == (group.path, whole):
                last.groups.append(group.index)
            else:
                tasks[-1].append(Piece(group.path, [group.index], whole))
            filled += group.size
        return tasks


class IndexedFiles(FooterIndex):
    """The same from a ``BoundsIndex``: no file of the table is opened, and its bounds are exact for every type.

    The index is opened as often as it has new parts; files that it does not know yet wait.
    """

    def __init__(self, uri: str, offset: OffsetColumn, folder: str) -> None:
        super().__init__(uri, offset)
        self._index_fs, self._folder = open_location(column_folder(folder, offset))
        self._seen: list[str] = []
        self._passed: Any = None

    def refresh(self) -> None:
        found = self._index_fs.get_file_info(fs.FileSelector(self._folder, allow_not_found=True))
        names = [f.base_name for f in found if f.type == fs.FileType.Directory]
        done = [n for n in names if self._index_fs.get_file_info(f"{self._folder}/{n}/_SUCCESS").type == fs.FileType.File]
        parts = part_names(done)
        if parts[: len(self._seen)] != self._seen:
            self._groups_of, self._seen = {}, []  # written anew as one
        for name in parts[len(self._seen) :]:
            self._apply(name)
        self._seen = parts
        self.loaded = True

    def _apply(self, name: str) -> None:
        table = pq.read_table(
            f"{self._folder}/{name}", filesystem=self._index_fs, partitioning=None, coerce_int96_timestamp_unit="us"
        )
        if self._offset.kind == TIMESTAMP:  # an old form of instants that Spark may write has no zone
            for at in ("least", "most"):
                table = table.set_column(table.schema.get_field_index(at), at, table[at].cast(pa.timestamp("us", "UTC")))
        entries: dict[FileKey, dict[int, RowGroup]] = {}
        for row in table.to_pylist():
            key = FileKey(row["file"], row["size"], row["modified"])
            if row["gone"]:
                self._groups_of.pop(key, None)
                continue
            blocks = entries.setdefault(key, {})
            if row["most"] is None:
                continue
            most = self._value(row["most"])
            if self._passed is None or most > self._passed:
                path = self._inner_path(row["file"])
                blocks[row["start"]] = RowGroup(
                    path, (row["start"], row["length"]), self._value(row["least"]), most,
                    row["rows"], row["length"], row["nulls"] + row["nans"] == 0,
                )
        self._groups_of.update({key: list(blocks.values()) for key, blocks in entries.items()})

    def _inner_path(self, uri: str) -> str:
        """A file as its file system names it; object stores have the bucket in front."""
        parts = urlsplit(uri)
        path = unquote(parts.path)
        return path if path.startswith(self._root) else f"{parts.netloc}{path}"

    def forget(self, end: str) -> None:
        super().forget(end)
        self._passed = self._offset.parse(end)

    def _read_extreme(self, group: RowGroup, largest: bool) -> str:
        return group.most if largest else group.least


def _row_groups(footer: pq.FileMetaData, wanted: list[int | tuple[int, int]]) -> list[int]:
    """Row groups by number; those of a block are the ones whose middle lies in it, as Spark deals them."""
    if not wanted or isinstance(wanted[0], int):
        return wanted
    out = []
    for i in range(footer.num_row_groups):
        group = footer.row_group(i)
        first = group.column(0)
        begin = first.data_page_offset
        if first.has_dictionary_page and 0 < first.dictionary_page_offset < begin:
            begin = first.dictionary_page_offset
        middle = begin + sum(group.column(c).total_compressed_size for c in range(group.num_columns)) // 2
        if any(start <= middle < start + length for start, length in wanted):
            out.append(i)
    return out


def _task_size(total: int, cores: int) -> int:
    """A few tasks for each core, neither so small that they cost more than they read nor too large."""
    return min(_LARGEST_TASK, max(_SMALLEST_TASK, total // (cores * _TASKS_PER_CORE)))


def _nan(value: Any) -> bool:
    return isinstance(value, float) and math.isnan(value)


def read_pieces(
    uri: str,
    pieces: list[Piece],
    schema: pa.Schema,
    offset: str,
    offset_type: pa.DataType,
    inside: Callable[[pa.Array], pa.Array],
) -> Iterator[pa.RecordBatch]:
    """The rows of ``pieces`` whose offset is ``inside``, as batches of ``schema``.

    One core and a few batches in memory per task, as Spark accounts for it.
    """
    system, root = open_location(uri)
    for path, groups, whole in pieces:
        constants = _folder_values(root, path)
        with system.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            groups = _row_groups(file.metadata, groups)
            if not groups:
                continue
            names = [n for n in file.schema_arrow.names if n == offset or n in schema.names]
            step = _batch_rows(file.metadata, groups)
            for batch in file.iter_batches(step, groups, names, use_threads=False):
                kept = batch
                if not whole:
                    kept = batch.filter(inside(_cast(batch.column(offset), offset_type)))
                if kept.num_rows:
                    yield _fitted(kept, schema, constants)


def _batch_rows(footer: pq.FileMetaData, groups: list[int]) -> int:
    """Fewer rows per batch where they are wide, so that a batch stays small in memory."""
    found = [footer.row_group(i) for i in groups]
    width = max(g.total_byte_size // max(g.num_rows, 1) for g in found)
    return max(1, min(_BATCH_ROWS, _BATCH_BYTES // max(width, 1)))


def _fitted(batch: pa.RecordBatch, schema: pa.Schema, constants: dict[str, str]) -> pa.RecordBatch:
    """``batch`` with exactly the columns of ``schema``; what a file lacks comes from its
    folder or is NULL."""
    columns = []
    for field in schema:
        if field.name in batch.schema.names:
            columns.append(_cast(batch.column(field.name), field.type))
        else:
            value = pa.scalar(constants.get(field.name), pa.string()).cast(field.type)
            columns.append(pa.repeat(value, batch.num_rows))
    return pa.record_batch(columns, schema=schema)


def _cast(column: pa.Array, to: pa.DataType) -> pa.Array:
    # Spark keeps microseconds, whatever finer unit a file was written with.
    return column.cast(to, safe=not pa.types.is_timestamp(to))
