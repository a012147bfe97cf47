"""Shared helpers: byte-level views of Arrow text, hashing in numpy, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.shipping import map_arrow, ship  # noqa: F401
from tidemark.plans.workspace import shared_folder

#: ``[^\x20\x09-\x0D]+`` as Spark's regular expressions write it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that numpy works on at once; a longer single text is one slice of its own.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: An odd multiplier and a value for each byte; fixed, so that hashes agree between tasks and runs.
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def release_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles deleted: Spark does so once the driver's garbage collection
    has met their owners, which in a driver with little to do comes late."""
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it again: a cut lineage that outlives executors.

    What was shuffled for it is not needed any more and is released. The table stays until the ``scratch`` block
    it is made in ends.
    """
    return write_table(df, shared_folder(df.sparkSession, purpose))


def write_table(df: DataFrame, path: str, **options: str) -> DataFrame:
    spark = df.sparkSession
    df.write.options(**options).parquet(path)
    release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Texts(NamedTuple):
    """Texts of some rows as one run of bytes; row ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray


def texts(column: pa.Array) -> Texts:
    """NULL counts as an empty text."""
    values = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    _, bounds, data = values.buffers()
    offsets = np.frombuffer(bounds, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class Words(NamedTuple):
    """Words ``[^\\x20\\x09-\\x0D]+``: byte bounds and the row of each."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def words(t: Texts) -> Words:
    n = len(t.data)
    solid = ~_SPACE[t.data]
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    before = np.ones(n, bool)
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:n]))
    after = np.ones(n, bool)
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return Words(starts, ends, np.repeat(np.arange(len(t.offsets) - 1), np.diff(np.searchsorted(starts, t.offsets))))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        tables.append(np.cumprod(steps, dtype=np.uint64))
    return tables[0], tables[1]


_LARGEST = [1 << 20]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier, and of its inverse, modulo 2**64."""
    _LARGEST[0] = max(_LARGEST[0], 1 << (n - 1).bit_length())
    up, down = _power_tables(_LARGEST[0])
    return up[:n], down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, its length included."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:-1], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` between each two neighbours in ``offsets``."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, dtype=np.int64, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
