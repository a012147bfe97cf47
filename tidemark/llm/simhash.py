"""SimHash fingerprints and their links by covering locality-sensitive hashing.

For radius r, bit i of a fingerprint gets a vector m(i) of r + 1 bits, and each non-zero vector v of
r + 1 bits a table: its key holds the bits with <m(i), v> = 1. The r bits in which two fingerprints
differ span at most r dimensions, so some v is orthogonal to all of them, and both have one key there:
every pair within the radius meets in one of the 2**(r + 1) - 1 tables, with certainty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lower_ascii, map_arrow, materialize, slices, texts, words
from tidemark.llm.components import connected_components

BITS = 64
#: Fingerprints of a key that one task compares; keys with more are covered again over the bits left.
KEY_LIMIT = 4096


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int, bits: list[int]) -> list[int]:
    """The bit masks that cover all pairs which differ in at most ``radius`` of ``bits``."""
    vectors = range(1, 1 << (radius + 1))
    return [
        sum(1 << bit for i, bit in enumerate(bits) if (vectors[i % len(vectors)] & v).bit_count() % 2)
        for v in vectors
    ]


def _row_fingerprints(column: pa.Array, shingle: int, seed: int) -> np.ndarray:
    t = texts(column)
    w = words(t)
    n = len(column)
    data = lower_ascii(t.data).tobytes()
    counts = np.bincount(w.rows, minlength=n)
    ends = np.cumsum(counts).tolist()
    starts, stops = w.starts.tolist(), w.ends.tolist()
    digest, digests, sizes, first = xxhash.xxh64_digest, [], [], 0
    for last in ends:
        k = last - first
        if k:
            own = [data[a:b] for a, b in zip(starts[first:last], stops[first:last])]
            joined = b" ".join(own)
            span = min(shingle, k)
            lengths = np.fromiter(map(len, own), np.int64, k)
            begin = np.cumsum(lengths + 1) - lengths - 1
            end = (begin + lengths)[span - 1 :].tolist()
            digests += [digest(joined[a:b], seed) for a, b in zip(begin.tolist(), end)]
            sizes.append(k - span + 1)
        first = last
    out = np.zeros(n, np.uint64)
    if sizes:
        raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
        total = np.array(sizes)
        at = np.cumsum(total) - total
        ones = np.add.reduceat(np.unpackbits(raw, axis=1), at, axis=0, dtype=np.int32)
        majority = np.packbits(2 * ones > total[:, None], axis=1)
        out[counts > 0] = majority.view(">u8").ravel()
    return out


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 3, seed: int = 42) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the 64 bits as a signed long) of every whole text.

    Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, shingles of ``shingle`` words
    (all words, if there are fewer) with repeats, XXH64 of each; a bit is set if it is set in over half
    of them. NULL, empty and blank texts have fingerprint 0. Other columns are left out.
    """
    source = df.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            fps = _row_fingerprints(batch.column(batch.num_columns - 1), shingle, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], schema.names)

    return map_arrow(source, run, schema)


def _forest(fps: np.ndarray, radius: int) -> list[tuple[np.ndarray, int]]:
    """Stars over the groups that are linked within ``radius``, each on its first member."""
    stars, rest = [], fps
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front, members = [root], []
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                members.append(rest[near])
                front.extend(rest[near])
                rest = rest[~near]
        if members:
            stars.append((np.concatenate(members), root))
    return stars


def _bucket_edges(radius: int):
    """Links within each run of rows with one bucket; the rows come sorted by bucket."""

    def edges(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fps = fp.view(np.uint64)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[first, len(bucket)])
        pair = first[sizes == 2]
        pair = pair[np.bitwise_count(fps[pair] ^ fps[pair + 1]) <= radius]
        src, dst = [fps[pair]], [fps[pair + 1]]
        for a, n in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            for members, root in _forest(fps[a : a + n], radius):
                src.append(members)
                dst.append(np.full(len(members), root, np.uint64))
        columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (src, dst)]
        return pa.RecordBatch.from_arrays(columns, ["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 2
        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            bucket, fp = held
            if len(bucket) and bucket[0] != bucket[-1]:
                cut = np.flatnonzero(bucket != bucket[-1])[-1] + 1
                yield edges(bucket[:cut], fp[:cut])
                held = [bucket[cut:], fp[cut:]]
        if len(held[0]):
            yield edges(*held)

    return run


def links(fps: DataFrame, radius: int = 3, key_limit: int = KEY_LIMIT) -> DataFrame:
    """Edges ``(src, dst)`` that join all fingerprints ``fp`` (distinct) linked within ``radius`` bits.

    Each bucket returns a forest over its links, not its pairs. A bucket with more than ``key_limit``
    fingerprints is covered once more over the bits outside its mask, so that what one task compares
    shares about 50 bits; nothing is left out.
    """
    masks = covering_masks(radius, list(range(BITS)))

    def tables(masked: list[int], name: str) -> Column:
        each = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("key")) for i, m in enumerate(masked)]
        return F.explode(F.array(*each)).alias(name)

    first = fps.select("fp", tables(masks, "a")).select("fp", F.col("a.t").alias("t"), F.col("a.key").alias("key"))
    first = first.withColumn("bucket", F.xxhash64("t", "key"))
    sizes = first.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(first.join(sizes, "bucket"), "buckets")

    inner = [covering_masks(radius, [b for b in range(BITS) if not m >> b & 1]) for m in masks]
    again = [
        shared.where((F.col("n") > key_limit) & (F.col("t") == t))
        .select("fp", "key", "t", tables(masked, "b"))
        .select(F.xxhash64("t", "key", "b.t", "b.key").alias("bucket"), "fp")
        for t, masked in enumerate(inner)
    ]
    dense = again[0]
    for more in again[1:]:
        dense = dense.union(more)
    buckets = shared.where(F.col("n") <= key_limit).select("bucket", "fp").union(dense)
    dealt = buckets.repartition("bucket").sortWithinPartitions("bucket", "fp")
    edges = map_arrow(dealt, _bucket_edges(radius), "src long, dst long")
    return edges.distinct()


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns ``keep``, ``fp``, ``root`` and ``component_id`` of every row.

    Rows are linked if their fingerprints differ in ``radius`` bits or fewer; ``component_id`` is the
    smallest key that links lead to, ``root`` the smallest fingerprint. Equal texts count as one
    fingerprint throughout, so their number does not matter; rows without a key take part, and a
    component of such rows only has the id NULL. Equal rows give equal rows, an empty table an empty one.
    """
    own = materialize(fingerprints(df, text, (key, *keep)), "fingerprints")
    distinct = own.groupBy("fp").agg(F.min(key).alias("low"))
    parts = connected_components(links(distinct.select("fp"), radius))
    rooted = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root")
    )
    rooted = materialize(rooted, "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return own.join(named, "fp").select(key, *keep, "fp", "root", "component_id")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 3) -> DataFrame:
    """All columns of one row of each group of near-duplicates: that with the smallest key, NULL last.

    Rows of one key are told apart by their hash; of rows equal in all columns one stays.
    """
    row = F.xxhash64(*df.columns)
    found = near_duplicates(df.select(text, key, row.alias("_row")), text, key, radius, ("_row",))
    order = F.struct(F.col(key).isNull(), F.col(key), F.col("_row"))
    found = materialize(found.groupBy("root", key, "_row").agg(F.count("*").alias("n")), "rows-of-groups")
    chosen = found.groupBy("root").agg(F.min_by(F.struct("_row", "n"), order).alias("c"))
    chosen = materialize(chosen.select(F.col("c._row").alias("_chosen"), F.col("c.n").alias("_n")), "rows-kept")
    kept = df.withColumn("_row", row).join(chosen, F.col("_row") == F.col("_chosen"))
    # A row hash that several rows have stands for equal rows.
    single = kept.where("_n = 1").select(*df.columns)
    repeated = kept.where("_n > 1").dropDuplicates(["_row"]).select(*df.columns)
    return single.union(repeated)
