"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as words: two are duplicates within one word inserted, deleted or
changed. Each line emits the hash of itself and of itself without each of its words. Lines without the
same word at the same place give equal variants, and so do a line and another without the word that
only one has. Of all lines with one variant only the earliest matters, so groups are reduced to their
minimum and no pairs within a group arise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD, Texts, lower_ascii, map_arrow, materialize, powers, slices, span_hashes, texts, words

#: Shorter lines stay whatever they repeat; lines of so many words may differ in one.
LEAST_WORDS, WORDS_PER_EDIT = 5, 10
_NO_ID = -(1 << 63)


def _line_words(t: Texts):
    """For each line with a word: its row, its number in the text, its first word and the one after its last."""
    w = words(t)
    breaks = np.concatenate([[0], np.cumsum(t.data == 10)])
    line = breaks[w.starts]
    number = line - breaks[t.offsets[:-1]][w.rows]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (w.rows[1:] != w.rows[:-1])
    first = np.flatnonzero(new)
    return w, w.rows[first], number[first], first, np.append(first[1:], len(line)).astype(np.int64)


def _sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of word hashes times powers: any run of words has its hash as a difference."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes) + 1)[0][:-1], dtype=np.uint64, out=out[1:])
    return out


def _lines(least_words: int, words_per_edit: int):
    """Rows of texts to rows of lines: hash, number of words, and the hashes of the halves.

    Two lines of n and n' words, one edit apart, share their first or last floor(min(n, n') / 2) words;
    so each line gives the hashes of its first and last n // 2 and (n - 1) // 2 words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            t = texts(batch.column(2))
            t = Texts(lower_ascii(t.data), t.offsets)
            w, rows, number, first, last = _line_words(t)
            sums = _sums(span_hashes(t.data, w.starts, w.ends))
            inverse = powers(len(sums))[1]
            n = last - first
            keep = n >= least_words
            rows, number, first, last, n = (x[keep] for x in (rows, number, first, last, n))

            def run_hash(a, b, salt):
                return (sums[b] - sums[a]) * inverse[a] ^ np.uint64(salt) * (b - a).astype(np.uint64)

            halves = []
            for m in (n // 2, (n - 1) // 2):
                halves += [run_hash(first, first + m, 0x9E3779B97F4A7C15), run_hash(last - m, last, 0xC2B2AE3D27D4EB4F)]
            keys = np.stack(halves, 1)
            long = n >= words_per_edit
            ends = np.cumsum(np.concatenate([[0], 4 * long])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)),
                    pa.array(number.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(run_hash(first, last, 0x165667B19E3779F9).view(np.int64)),
                    pa.ListArray.from_arrays(ends, keys[long].view(np.int64).ravel()),
                ],
                ["id", "text_hash", "line", "n", "h", "halves"],
            )

    return run


def _named_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text, lines wanted with their hashes) to rows of those lines."""
    for batch in batches:
        ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        out = []
        for key, text, lines in zip(ids, batch.column(1).to_pylist(), wanted):
            every = text.split("\n")
            out += [(key, x["line"], x["h"], every[x["line"]].encode().lower()) for x in lines]
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "line", "h", "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line's own hash (place -1) and its hash without each word in turn."""
    for batch in batches:
        for own in slices([batch], "words", 1 << 18):
            t = texts(own.column(3))
            w = words(t)
            hashes = span_hashes(t.data, w.starts, w.ends)
            counts = np.bincount(w.rows, minlength=own.num_rows)
            keys, places, which = [], [], []
            for i, (a, b) in enumerate(zip(np.cumsum(counts) - counts, np.cumsum(counts))):
                sums = _sums(hashes[a:b])
                down = powers(2)[1][1]
                without = sums[:-1] + (sums[-1] - sums[1:]) * down
                keys.append(np.append(without, sums[-1]))
                places.append(np.append(np.arange(b - a), -1))
                which.append(np.full(b - a + 1, i))
            at = pa.array(np.concatenate(which))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    *(own.column(i).take(at) for i in range(3)),
                ],
                ["variant", "place", "id", "line", "h"],
            )


def one_edit(a: list, b: list) -> bool:
    """Whether at most one element must be inserted, deleted or changed."""
    if abs(len(a) - len(b)) > 1:
        return False
    most = min(len(a), len(b))
    front = next((i for i in range(most) if a[i] != b[i]), most)
    back = next((i for i in range(most - front) if a[-1 - i] != b[-1 - i]), most - front)
    return front + back >= max(len(a), len(b)) - 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        good = [one_edit(a.split(), b.split()) for a, b in pairs]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good, pa.bool_()))], ["h"])


def duplicate_lines(df: DataFrame, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS, words_per_edit: int = WORDS_PER_EDIT) -> DataFrame:
    """``(id, text_hash, line, near)``: every line that an earlier line makes redundant.

    Lines are the ``\\n``-separated parts of a text, compared as words ``[^\\x20\\x09-\\x0D]+`` with A-Z in
    lower case. A line of ``least_words`` words or more goes if an earlier one has the same words, or, if
    both have ``words_per_edit`` words or more, if one is at most one word edit away (``near``); also if
    that one goes itself. Earlier: by key (NULL first), line number, then text. Shorter lines stay.
    Rows equal in key and text count as one document and get the same result. ``id`` is the key, or the
    smallest long for NULL. Keys are whole numbers; others are refused.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError(f"Lines are ordered by whole numbers; '{key}' is {df.schema[key].dataType.simpleString()}.")
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    lines = materialize(
        map_arrow(docs.where("_text IS NOT NULL"), _lines(least_words, words_per_edit), "id long, text_hash long, line int, n int, h long, halves array<long>"),
        "lines",
    )
    first = F.min(F.struct("id", "line", "text_hash")).alias("first")
    distinct = materialize(lines.groupBy("h").agg(first, F.first("halves").alias("halves")), "distinct-lines")

    # Only lines that share a half with another line can have a neighbour within one edit.
    halves = distinct.select("h", F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    near = halves.join(shared, "half", "left_semi").select("h").distinct()
    wanted = distinct.join(near, "h").select("first.*", "h").groupBy("id", "text_hash").agg(F.collect_list(F.struct("line", "h")).alias("lines"))
    # Written before the texts are shuffled; as many as documents with such lines, so never to be broadcast.
    wanted = materialize(wanted, "wanted-lines")
    source = docs.join(wanted.hint("merge"), ["id", "text_hash"]).select("id", "_text", "lines")
    named = materialize(map_arrow(source, _named_lines, "id long, line int, h long, words binary").dropDuplicates(["h"]), "named-lines")

    variants = materialize(map_arrow(named, _variants, "variant long, place int, id long, line int, h long"), "variants")
    at = F.struct("id", "line", "h")
    whole = variants.where("place < 0").select("variant", at.alias("whole"))
    parts = variants.where("place >= 0").select("variant", "place", at.alias("part"))
    # Equal but for the word at one place: the earliest of the group makes the others redundant.
    lowest = parts.groupBy("variant", "place").agg(F.min("part").alias("low"), F.count("*").alias("n")).where("n > 1")
    changed = parts.join(lowest, ["variant", "place"]).where("part > low").select(F.col("part.h").alias("h"), F.col("low.h").alias("by"))
    # One word more or less: the shorter line against the earliest longer one, each longer one against the shorter.
    longer = parts.groupBy("variant").agg(F.min("part").alias("low"))
    dropped = whole.join(longer, "variant").where("whole > low").select(F.col("whole.h").alias("h"), F.col("low.h").alias("by"))
    added = parts.join(whole, "variant").where("part > whole").select(F.col("part.h").alias("h"), F.col("whole.h").alias("by"))
    pairs = changed.union(dropped).union(added).distinct()
    mine, theirs = named.select("h", F.col("words").alias("a")), named.select(F.col("h").alias("by"), F.col("words").alias("b"))
    checked = map_arrow(pairs.join(mine, "h").join(theirs, "by").select("h", "a", "b"), _verified, "h long").distinct()
    checked = materialize(checked, "near-lines")
    told = distinct.select("h", "first").join(checked.withColumn("near", F.lit(True)), "h", "left")

    repeated = lines.select("id", "text_hash", "line", "h").join(told, "h").withColumn("near", F.coalesce("near", F.lit(False)))
    redundant = F.col("near") | (F.struct("id", "line", "text_hash") != F.col("first"))
    return repeated.where(redundant).select("id", "text_hash", "line", "near")


def _without(lines: Column, gone: Column) -> Column:
    return F.filter(lines, lambda _, i: ~F.array_contains(gone, i))


def dedup_lines(df: DataFrame, text: str = "text", key: str = "doc_id", least_words: int = LEAST_WORDS, words_per_edit: int = WORDS_PER_EDIT) -> DataFrame:
    """All columns with ``text`` less its redundant lines (see ``duplicate_lines``), and the lists
    ``same_lines`` and ``near_lines`` of what went, as line numbers.

    A NULL text stays NULL and an empty one empty; a text that loses no line stays as it is, byte by byte.
    Columns that are called like the two lists are replaced.
    """
    found = duplicate_lines(df, text, key, least_words, words_per_edit)
    listed = found.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_set(F.when(~F.col("near"), F.col("line")))).alias("_same"),
        F.sort_array(F.collect_set(F.when(F.col("near"), F.col("line")))).alias("_near"),
    )
    listed = materialize(listed, "lines-gone").hint("merge")  # as many as documents: never to be broadcast
    columns = [c for c in df.columns if c not in ("same_lines", "near_lines")]
    ids = F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("_dedup_id"), F.xxhash64(text).alias("_dedup_hash")
    own = df.select(*columns, *ids)
    joined = own.join(listed, (own["_dedup_id"] == listed["id"]) & (own["_dedup_hash"] == listed["text_hash"]), "left")
    none = F.array().cast("array<int>")
    same, near = F.coalesce(listed["_same"], none), F.coalesce(listed["_near"], none)
    left = F.array_join(_without(F.split(own[text], "\n", -1), F.concat(same, near)), "\n")
    rest = F.when(listed["id"].isNull(), own[text]).otherwise(left)
    kept = [rest.alias(c) if c == text else own[c] for c in columns]
    return joined.select(*kept, same.alias("same_lines"), near.alias("near_lines"))


def has_words(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(WORD), F.lit(False))
