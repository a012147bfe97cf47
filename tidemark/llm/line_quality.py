"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

Viterbi decoding gives the best label sequence of a document; the share of its words in content lines
decides whether it stays. Counts and features of many documents are computed at once on their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import Texts, map_arrow, mix, per_row, slices, span_hashes, texts, words

#: The default bound on labelled documents of each class that the field is fitted on.
SAMPLE = 1500
#: Lines of a document that fitting takes at a time, and rounds of fitting.
SEGMENT, ROUNDS = 40, 150
#: How much a document's label says of each of its lines, in log odds.
TRUST = 0.25
#: Segments of a document that are fitted on at most, evenly spread over it.
SEGMENTS = 50
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "symbols", "marks", "upper", "digits", "not_ascii", "word_length", "words", "ends_in_mark", "repeated", "duplicate", "empty",
)


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_SYMBOL = _class("#*$%&|<>")
_MARK = _class("!?.,;:-_=+~@^/\\()[]{}\"'")
_END = _class(".!?:;")
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_SOLID = ~_class(" \t\n\x0b\x0c\r")


class Lines(NamedTuple):
    """Counts by document, and features, words and document of each line."""

    counts: dict[str, np.ndarray]
    features: np.ndarray
    n_words: np.ndarray
    rows: np.ndarray
    #: Lines of each document; a text always has one at least.
    per_doc: np.ndarray


def _repeats(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of eight that its document has twice or more."""
    n, out = len(hashes), np.zeros(len(hashes), bool)
    if n < WINDOW:
        return out
    m = n - WINDOW + 1
    window = np.zeros(m, np.uint64)
    for i in range(WINDOW):
        window = (window + hashes[i : i + m]) * np.uint64(0x9FB21C651E98DF25)
    same = np.flatnonzero(rows[:m] == rows[WINDOW - 1 :])
    key = mix(window[same] + rows[same].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= equal
    twice[order[:-1]] |= equal
    step = np.zeros(n + 1, np.int64)
    step[same[twice]] += 1
    step[same[twice] + WINDOW] -= 1
    return np.cumsum(step[:-1]) > 0


def describe(t: Texts) -> Lines:
    """The counts and line features of some texts; everything is counted over whole texts."""
    data, offsets, n = t.data, t.offsets, len(t.offsets) - 1
    w = words(t)
    points = (data & 0xC0) != 0x80
    solid = points & _SOLID[data]
    hashes = span_hashes(data, w.starts, w.ends)
    repeated = _repeats(hashes, w.rows)

    # A line starts with each text and after each \n.
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    per_doc = np.bincount(rows, minlength=n)
    last = np.append(rows[1:] != rows[:-1], np.ones(min(n, 1), bool))
    ends = np.where(last, offsets[1:][rows], np.append(starts[1:], 0)[: len(starts)] - 1)

    def between(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[ends] - sums[starts]

    first_word = np.searchsorted(w.starts, starts, "left")
    after_word = np.searchsorted(w.starts, ends, "left")
    line_words = after_word - first_word
    sums = np.zeros(len(repeated) + 1, np.int64)
    np.cumsum(repeated, out=sums[1:])
    line_repeats = sums[after_word] - sums[first_word]

    filled = np.flatnonzero(line_words > 0)
    key = mix(span_hashes(data, starts[filled], ends[filled]) + rows[filled].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    by_key = np.argsort(key, kind="stable")
    duplicate = np.zeros(len(starts), bool)
    duplicate[filled[by_key[1:]]] = key[by_key[1:]] == key[by_key[:-1]]

    counts = {
        "n_words": np.bincount(w.rows, minlength=n),
        "word_chars": per_row(solid, offsets),
        "n_symbols": per_row(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(rows[duplicate], minlength=n),
        "n_repeat_words": np.bincount(w.rows[repeated], minlength=n),
    }
    size = np.maximum(between(solid), 1)
    at_least = np.maximum(line_words, 1)
    end_mark = np.zeros(len(starts), bool)
    end_mark[filled] = _END[data[w.ends[after_word[filled] - 1] - 1]] if len(filled) else False
    features = np.stack(
        [
            between(_SYMBOL[data]) / size,
            between(_MARK[data]) / size,
            between(_UPPER[data]) / size,
            between(_DIGIT[data]) / size,
            between(points & (data >= 128)) / size,
            np.minimum(size / at_least, 30) / 10,
            np.log1p(line_words) / 4,
            end_mark,
            line_repeats / at_least,
            duplicate,
            line_words == 0,
        ],
        axis=1,
    ).astype(np.float64)
    return Lines(counts, features, line_words, rows, per_doc)


class LineField(NamedTuple):
    """Weights of the field; label 1 is content. ``emit``: a row for each feature and the bias, a column for each label."""

    emit: np.ndarray
    move: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return x @ self.emit[:-1] + self.emit[-1]

    def viterbi(self, features: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        """The best label of each line, by document; ties go to content.

        All documents advance by one line at a time, the long ones alone at the end.
        """
        n = len(features)
        labels = np.zeros(n, np.int8)
        if not n:
            return labels
        score = self.scores(features)
        first = np.cumsum(per_doc) - per_doc
        order = np.argsort(-per_doc, kind="stable")
        first, length = first[order], per_doc[order]
        back = np.zeros((n, 2), np.int8)
        best = score[first[length > 0]]
        for k in range(1, int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -k, "left"))
            at = first[:live] + k
            path = best[:live, :, None] + self.move
            content = path[:, 1, :] >= path[:, 0, :]
            back[at] = content
            best[:live] = np.where(content, path[:, 1, :], path[:, 0, :]) + score[at]
        label = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for k in range(int(length.max(initial=0)) - 1, -1, -1):
            live = int(np.searchsorted(-length, -k, "left"))
            at = first[:live] + k
            labels[at] = label[:live]
            label[:live] = back[at, label[:live]]
        return labels


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def _expected(score: np.ndarray, move: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each label of each line, and of each two labels of neighbours summed over lines, by forward-backward."""
    fore, back = np.empty_like(score), np.zeros_like(score)
    last = score.shape[1]
    fore[:, 0] = score[:, 0]
    for i in range(1, last):
        step = _logsum(fore[:, i - 1, :, None] + move, 1) + score[:, i]
        fore[:, i] = np.where(mask[:, i, None], step, fore[:, i - 1])
    for i in range(last - 2, -1, -1):
        step = _logsum(move + (score[:, i + 1] + back[:, i + 1])[:, None, :], 2)
        back[:, i] = np.where(mask[:, i + 1, None], step, 0)
    total = _logsum(fore[:, -1], 1)
    chance = np.exp(np.minimum(fore + back - total[:, None, None], 0)) * mask[..., None]
    pairs = fore[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - total[:, None, None, None]
    return chance, (np.exp(np.minimum(pairs, 0)) * mask[:, 1:, None, None]).sum(1)


def _observed(labels: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of given labels."""
    truth = np.stack([labels == 0, labels == 1], 2) * mask[..., None]
    pairs = np.einsum("nia,nib->nab", truth[:, :-1].astype(float), truth[:, 1:].astype(float))
    return truth.astype(float), pairs


def fit_field(
    docs: list[np.ndarray], content: list[bool], rounds: int = ROUNDS, rate: float = 0.1, decay: float = 1e-3, trust: float = TRUST
) -> LineField:
    """Maximum likelihood by forward-backward, with line labels that are found first.

    What is known is the label of a document; that of its lines is hidden. In the first third of the rounds lines are
    fitted one by one, each with its document's label. A line that then looks more like the other label than
    ``trust`` (log odds) takes that one, so that a footer in a good document and a sentence in a bad one count as what
    they look like; a document all of whose lines would turn keeps its label for all. With these labels the chain is
    fitted, and learns where labels change within a document. Documents are cut into segments of
    ``SEGMENT`` lines; both classes weigh the same.
    """
    parts = [(d[i : i + SEGMENT], y) for d, y in zip(docs, content) for i in range(0, len(d), SEGMENT)]
    everything = np.concatenate([p for p, _ in parts])
    mean, scale = everything.mean(0), np.maximum(everything.std(0), 1e-3)
    n, f = len(parts), everything.shape[1]
    length = np.array([len(p) for p, _ in parts])
    y = np.array([int(c) for _, c in parts])
    x = np.zeros((n, SEGMENT, f + 1))
    for i, (p, _) in enumerate(parts):
        x[i, : len(p), :-1] = (p - mean) / scale
        x[i, : len(p), -1] = 1
    mask = np.arange(SEGMENT) < length[:, None]
    lines = np.array([max(1, length[y == c].sum()) for c in (0, 1)])
    weight = (1 / lines)[y] / 2
    emit, move = np.zeros((f + 1, 2)), np.zeros((2, 2))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (emit, move)]
    owner = np.repeat(np.arange(len(docs)), [-(-len(d) // SEGMENT) for d in docs])
    labels = np.repeat(y[:, None], SEGMENT, 1)
    truth, seen = _observed(labels, mask)
    for k in range(1, rounds + 1):
        score = x @ emit
        if 3 * (k - 1) <= rounds < 3 * k:  # from here on by lines
            margin = score[..., 1] - score[..., 0]
            turned = np.where(labels == 1, margin < -trust, margin > trust) & mask
            turned &= (np.bincount(owner, turned.sum(1)) < np.bincount(owner, length))[owner][:, None]
            labels = labels ^ turned
            truth, seen = _observed(labels, mask)
        chained = 3 * k > rounds
        chance, pairs = _expected(score, move, mask)
        slopes = (
            np.tensordot(x, (truth - chance) * weight[:, None, None], ([0, 1], [0, 1])) - decay * emit,
            ((seen - pairs) * weight[:, None, None]).sum(0) * chained - decay * move,
        )
        for w, g, m in zip((emit, move), slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            w += rate * (m[0] / (1 - 0.9**k)) / (np.sqrt(m[1] / (1 - 0.99**k)) + 1e-8)
    return LineField(emit, move, mean, scale)


def _spread(lines: np.ndarray) -> np.ndarray:
    """The lines of at most ``SEGMENTS`` segments."""
    n = -(-len(lines) // SEGMENT)
    if n <= SEGMENTS:
        return lines
    return np.concatenate([lines[i * SEGMENT : (i + 1) * SEGMENT] for i in np.linspace(0, n - 1, SEGMENTS).astype(int)])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField | None:
    """A field from labelled documents: those of ``labels`` with quality 1 are content, with 0 boilerplate.

    ``sample`` bounds the documents of each class, ``SEGMENTS`` the parts of one; those of the smallest hash of ``doc_id``
    are taken, so that reruns agree. ``doc_id`` may be of any type that can be joined. Of rows with one ``doc_id`` that whose text has the smallest hash counts, once.
    None if one class is missing. Rows with a NULL in either table are skipped.
    """
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    own = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    picked = [own.where(F.col("quality") == c).dropDuplicates(["doc_id"]).orderBy(rank, "doc_id").limit(sample) for c in (0, 1)]
    chosen = picked[0].union(picked[1])
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("quality int, hash long, features binary")])
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, tuple] = {}
        for batch in slices(batches, "text"):
            keys, hashes = list(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())), batch.column(2).to_pylist()
            mine: dict[tuple, int] = {}
            for i, (key, h) in enumerate(zip(keys, hashes)):
                if (key not in least or h < least[key][2]) and (key not in mine or h < hashes[mine[key]]):
                    mine[key] = i
            if mine:
                own = batch.take(pa.array(mine.values()))
                found = describe(texts(own.column(1)))
                cuts = np.cumsum(found.per_doc)[:-1]
                raw = [_spread(x).tobytes() for x in np.split(found.features, cuts)]
                least |= {key: (*key, h, x) for key, h, x in zip(mine, own.column(2).to_pylist(), raw)}
        for row in least.values():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, shape)], shape.names)

    # Of rows with one doc_id that of the smallest hash, first in each task.
    found = map_arrow(rows, run, schema)
    found = found.groupBy("doc_id", "quality").agg(F.min_by("features", "hash").alias("features"))
    found = found.orderBy("doc_id", "features").toArrow().to_pydict()
    if len(set(found["quality"])) < 2:
        return None
    arrays = [np.frombuffer(x).reshape(-1, len(FEATURES)) for x in found["features"]]
    return fit_field(arrays, [q == 1 for q in found["quality"]])


def judge(
    df: DataFrame, field: LineField | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least_share: float = 0.5, prefix: str = ""
) -> DataFrame:
    """The columns ``keep``, the counts, ``base_failed``, ``content_share`` and ``kept`` of every row.

    ``content_share`` is the share of words in lines that Viterbi labels content; a document stays if it
    is at least ``least_share`` and the base rules hold (20 words, at most 30% of them in repeated
    windows). Without a field all lines are content. NULL and empty texts have no words and go. Other
    columns are left out; ``prefix`` goes before the new names, for tables that have columns of these
    names. Equal rows give equal rows, an empty table an empty one.
    """
    source = df.select(*keep, *([] if text in keep else [text]))
    at, n_kept = source.columns.index(text), len(keep)
    kinds = {c: T.LongType() for c in COUNTS} | {"base_failed": T.BooleanType(), "content_share": T.DoubleType(), "kept": T.BooleanType()}
    schema = T.StructType([*source.schema.fields[:n_kept], *(T.StructField(prefix + c, k, False) for c, k in kinds.items())])
    if len({f.name.lower() for f in schema}) < len(schema):
        raise ValueError("Columns to keep are called like the new ones: give a prefix.")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = describe(texts(batch.column(at)))
            counts = found.counts
            content = found.n_words if field is None else found.n_words * field.viterbi(found.features, found.per_doc)
            total = counts["n_words"]
            share = np.bincount(found.rows, content, len(total)) / np.maximum(total, 1)
            failed = (total < 20) | (100 * counts["n_repeat_words"] > 30 * total)
            columns = [*(counts[c] for c in COUNTS), failed, share, ~failed & (share >= least_share)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *map(pa.array, columns)], schema.names)

    return map_arrow(source, run, schema)
