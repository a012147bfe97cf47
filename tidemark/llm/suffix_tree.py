"""Language-model scoring by a probabilistic suffix tree over words.

The root knows every word of the training texts. A context of one or more words is a state if a
divergence test tells its next-symbol distribution from that of its longest proper suffix. A state lists
the next symbols it was seen with at least ``LEAST`` times, with discounted counts; the mass left over
goes to all others in proportion to the suffix's distribution, so every state's distribution sums to 1. A
word is scored by the longest suffix of what stands before it that is a state.

Counts cover the whole corpus, and ``LEAST`` is the same at every size, so the tree grows with the
corpus: it is a written table of nodes, of which chunks of documents fetch their own by a join. A node
is a run of words by its key, which joins the keys of the runs without its last and without its first
word; it has a count, what it gains as a transition on what its suffix says and, if it is a state, the
share that goes to its suffix. A text's score is a sum over its runs, so one weight for each run is all
that is fetched. Texts are counted and scored in turns, so that only a part of what is shuffled lies on
disk at a time. Keys are dealt to buckets by their highest bits; what a task has for a bucket is one row
of arrays, and buckets ask one another for each key once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Texts, lower_ascii, map_arrow, materialize, mix, release_shuffles, ship, slices, span_hashes, texts, words, write_table
from tidemark.plans.workspace import scratch, shared_folder

#: Least occurrences of a listed transition, at every size.
LEAST = 2
#: Counts are lessened by this before what is left goes to unlisted symbols.
DISCOUNT = 0.75
#: Tokens counted at once, and bytes of text whose nodes are looked up together.
TOKENS_AT_ONCE, CHUNK_BYTES = 1 << 21, 8 << 20
#: Turns in which runs are counted, and in which texts are scored.
COUNT_PARTS, PARTS = 3, 4
#: Keys of a bucket, about.
KEYS_A_BUCKET = 1 << 20
#: Columns that hold hardly a value twice: Parquet is spared the search for any.
HASHED = ("key", "head", "tail", "weight")
_END, _START = 1, 2


class Tokens(NamedTuple):
    """Hashes of the tokens of some texts, an end after each; the text of each token."""

    hashes: np.ndarray
    rows: np.ndarray


def tokens(column: pa.Array) -> Tokens:
    t = texts(column)
    t = Texts(lower_ascii(t.data), t.offsets)
    w = words(t)
    n = len(t.offsets) - 1
    sizes = np.bincount(w.rows, minlength=n) + 1
    out = np.full(int(sizes.sum()), _END, np.uint64)
    out[np.arange(len(w.rows)) + w.rows] = span_hashes(t.data, w.starts, w.ends)
    return Tokens(out, np.repeat(np.arange(n), sizes))


class Runs(NamedTuple):
    """``keys[m]`` at each place: of the run of m + 1 tokens that ends there, if ``place`` is at least m.

    A start stands before each text, at place 0. ``rows``: the text of each place.
    """

    keys: list[np.ndarray]
    place: np.ndarray
    rows: np.ndarray


def _joined(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The key of a run, from that without its last and that without its first token."""
    return mix(mix(head) * np.uint64(0x9E3779B97F4A7C15) + tail)


def runs(t: Tokens, depth: int) -> Runs:
    first = np.flatnonzero(np.diff(t.rows, prepend=-1))
    hashes = np.insert(t.hashes, first, np.uint64(_START))
    starts = first + np.arange(len(first))
    lengths = np.diff(np.append(starts, len(hashes)))
    place = np.arange(len(hashes)) - np.repeat(starts, lengths)
    keys = [hashes]
    for _ in range(depth):
        key = np.zeros(len(hashes), np.uint64)
        key[1:] = _joined(keys[-1][:-1], keys[-1][1:])
        keys.append(key)
    return Runs(keys, place, np.repeat(t.rows[first], lengths))


def _order(keys: np.ndarray) -> np.ndarray:
    """What sorts ``keys``. Numbers are sorted several times faster than their places, so each place is written
    into the lowest bits of its key; keys that differ in those bits alone are put right after that."""
    low = np.uint64((1 << max(len(keys) - 1, 1).bit_length()) - 1)
    packed = np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    found = keys[order]
    packed &= ~low
    for x in np.unique(packed[:-1][found[1:] < found[:-1]]):
        a, b = np.searchsorted(packed, x), np.searchsorted(packed, x, "right")
        order[a:b] = order[a:b][np.argsort(keys[order[a:b]])]
    return order


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[_firsts(keys)]


def _places(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``keys`` are among the sorted ``known``, and where each of these is."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = np.flatnonzero(known[at] == keys)
    return hit, at[hit]


def _bits(n_keys: int) -> int:
    """Highest bits of a key that number its bucket."""
    return max(0, int(np.ceil(np.log2(max(n_keys, 1) / KEYS_A_BUCKET))))


def _number(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(63 - bits) >> np.uint64(1)


def _dealt(keys: np.ndarray, bits: int, **columns: np.ndarray) -> dict[str, pa.Array]:
    """A row for each bucket that some of the sorted ``keys`` are in: its number, and its part of each column as a list."""
    number = _number(keys, bits)
    first = _firsts(number)
    bounds = pa.array(np.append(first, len(keys)).astype(np.int32))
    values = {k: pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for k, c in columns.items()}
    return {"bucket": pa.array(number[first].astype(np.int32)), **{k: pa.ListArray.from_arrays(bounds, v) for k, v in values.items()}}


def _flat(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The values of all lists; keys are unsigned."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.view(np.uint64) if values.dtype == np.int64 else values


def _flats(table: pa.Table, *names: str, by: str | None = None) -> list[np.ndarray]:
    """The values of all lists of some columns, of rows in the order of column ``by``."""
    if by and table.num_rows > 1:
        table = table.take(np.argsort(table.column(by).to_numpy(), kind="stable"))
    return [_flat(table.column(x)) for x in names]


def _row(numbers: dict[str, int], **columns: np.ndarray) -> pa.Table:
    """One row, of numbers and of lists."""
    lists = {k: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c.view(np.int64) if c.dtype == np.uint64 else c)) for k, c in columns.items()}
    return pa.table({**{k: pa.array([v], pa.int32()) for k, v in numbers.items()}, **lists})


def _written(rows: DataFrame, path: str) -> DataFrame:
    return write_table(rows, path, **{f"parquet.enable.dictionary#{x}.list.element": "false" for x in HASHED})


def _in_turns(of_part, parts: int, purpose: str) -> DataFrame:
    """All parts, written one after the other. What a part shuffled goes before the next one starts, which takes that
    nothing refers to its plan any more."""
    written = []
    for part in range(parts):
        rows = of_part(part)
        written.append(_written(rows, shared_folder(rows.sparkSession, purpose)))
        del rows
        release_shuffles(written[-1].sparkSession)
    return reduce(DataFrame.unionAll, written)


def _counts(docs: DataFrame, bits: int, sizes: range, least: int = 1, parts: int = 1) -> DataFrame:
    """``(size, bucket, key, head, tail, c)`` of every run of so many tokens that is seen at least ``least`` times, and
    of every token: a row of arrays for each size and bucket, by key. ``head`` and ``tail``: none if the size is 1."""
    none = np.zeros(0, np.uint64)

    def counted(size: int, found: list[list[np.ndarray]]) -> pa.RecordBatch:
        keys, *rest = (np.concatenate(x) for x in zip(*found))
        order = _order(keys) if rest else np.sort(keys)
        keys = keys[order] if rest else order
        first = _firsts(keys)
        head, tail = (x[order[first]] for x in rest) if rest else (keys[first], keys[first])
        dealt = _dealt(keys[first], bits, head=head, tail=tail if rest else head, c=np.diff(np.append(first, len(keys))).astype(np.int32))
        if not rest:
            dealt["tail"] = pa.ListArray.from_arrays(pa.array(np.zeros(len(dealt["bucket"]) + 1, np.int32)), pa.array([], pa.int64()))
        return pa.RecordBatch.from_pydict({"size": pa.array(np.full(len(dealt["bucket"]), size, np.int32)), **dealt})

    def merged(group: pa.Table) -> pa.Table:
        size, bucket = (group.column(x)[0].as_py() for x in ("size", "bucket"))
        head, tail, c = _flats(group, "head", "tail", "c")
        keys = head if size == 1 else _joined(head, tail)
        order = _order(keys)
        first = _firsts(keys[order])
        total = np.add.reduceat(c[order].astype(np.int64), first)
        kept = np.flatnonzero(total >= (1 if size == 1 else least))
        at = order[first[kept]]
        head, tail = (none, none) if size == 1 else (head[at], tail[at])
        return _row({"size": size, "bucket": bucket}, key=keys[at], head=head, tail=tail, c=total[kept])

    def of_part(part: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {size: [] for size in sizes}
            n = 0
            for batch in slices(batches, "text"):
                r = runs(tokens(batch.column(0)), sizes[-1] - 1)
                for size, found in held.items():
                    m = size - 1
                    mine = r.place >= max(m, 1)
                    if parts > 1:
                        mine &= _number(r.keys[m], bits) * np.uint64(parts) >> np.uint64(bits) == part
                    at = np.flatnonzero(mine)
                    found.append([r.keys[m][at]] if m == 0 else [r.keys[m][at], r.keys[m - 1][at - 1], r.keys[m - 1][at]])
                    n += len(at)
                if n >= TOKENS_AT_ONCE:
                    yield from (counted(size, found) for size, found in held.items())
                    held, n = {size: [] for size in sizes}, 0
            if n:
                yield from (counted(size, found) for size, found in held.items())

        seen = map_arrow(docs.select("text"), run, "size int, bucket int, head array<long>, tail array<long>, c array<int>")
        kind = "size int, bucket int, key array<long>, head array<long>, tail array<long>, c array<long>"
        return seen.groupBy("size", "bucket").applyInArrow(merged, kind)

    return _in_turns(of_part, parts, "run-counts")


def word_counts(docs: DataFrame) -> DataFrame:
    """``(key, c)`` for every token of the texts, by hash."""
    return _counts(docs, 0, range(1, 2)).select(F.explode(F.arrays_zip("key", "c")).alias("of")).select("of.key", "of.c")


def _asks(rows: DataFrame, of_row, kind: str = "") -> DataFrame:
    """What ``of_row`` asks for, for each row of arrays; ``origin`` is the row's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = of_row(batch.slice(i, 1))
                origin = pa.array(np.full(len(asked["bucket"]), batch.column("bucket")[i].as_py(), np.int32))
                yield pa.RecordBatch.from_pydict({"origin": origin, **asked})

    return map_arrow(rows, run, f"origin int, bucket int, key array<long>{kind}")


def _cogrouped(left: DataFrame, right: DataFrame, of_both, kind: str, by: str = "bucket") -> DataFrame:
    return left.groupBy("bucket").cogroup(right.groupBy(by)).applyInArrow(of_both, kind)


def _transitions(contexts: DataFrame, runs_of: DataFrame, bits: int, path: str) -> DataFrame:
    """``(bucket, key, head, c, parent)`` of runs, as a written table: ``parent`` is the log of the chance of their last
    token by the longest suffix of the others that is a state. Each bucket asks for each tail once.

    ``contexts``: ``(bucket, key, c, gained, chance)`` of the runs of one token less, ``chance`` the log of the chance
    of their last token by the longest suffix of the others that is a state, or by all others if they are one.
    """

    def tails(row: pa.RecordBatch) -> dict[str, pa.Array]:
        keys = _distinct(_flat(row.column("tail")))
        return _dealt(keys, bits, key=keys)

    def chances(asks: pa.Table, known: pa.Table) -> pa.Table:
        # A frequent run's tail is frequent, so every one finds the chance its suffix gives.
        keys, chance = _flats(known, "key", "chance")
        _, at = _places(keys, _flat(asks.column("key")))
        lists = pa.ListArray.from_arrays(asks.column("key").combine_chunks().offsets, pa.array(chance[at])) if asks.num_rows else pa.array([], pa.list_(pa.float64()))
        return pa.table({"origin": asks.column("origin"), "bucket": asks.column("bucket"), "chance": lists})

    def with_parent(rows: pa.Table, answers: pa.Table) -> pa.Table:
        key, head, tail, c = _flats(rows, "key", "head", "tail", "c")
        (chance,) = _flats(answers, "chance", by="bucket")
        parent = chance[np.searchsorted(_distinct(tail), tail)]
        return _row({"bucket": rows.column("bucket")[0].as_py()}, key=key, head=head, c=c, parent=parent)

    asked = _asks(runs_of.select("bucket", "tail"), tails)
    answers = _cogrouped(asked, contexts.select("bucket", "key", "chance"), chances, "origin int, bucket int, chance array<double>")
    kind = "bucket int, key array<long>, head array<long>, c array<long>, parent array<double>"
    return _written(_cogrouped(runs_of.select("bucket", "key", "head", "tail", "c"), answers, with_parent, kind, "origin"), path)


def _states(contexts: DataFrame, listed: DataFrame, size: int, bits: int, nodes_at: str, contexts_at: str) -> tuple[DataFrame, DataFrame]:
    """The nodes of the ``contexts``, which have ``size`` tokens, and their ``listed`` transitions as contexts; both as
    written tables.

    A context is a state if its divergence from its suffix, times its occurrences, exceeds what its listed transitions
    cost to describe: half the log of the occurrences each. Sums by context are all it takes, so each bucket of
    transitions sums up its own first, and asks for the state of each context once.
    """

    def sums(row: pa.RecordBatch) -> dict[str, pa.Array]:
        head, c, parent = (_flat(row.column(x)) for x in ("head", "c", "parent"))
        order = _order(head)
        first = _firsts(head[order])
        if not len(first):
            return _dealt(head, bits, key=head, k=head, seen=head, gained=parent, covered=parent)
        c, parent = c[order].astype(float), parent[order]
        gained, covered = np.add.reduceat(c * (np.log(c - DISCOUNT) - parent), first), np.add.reduceat(np.exp(parent), first)
        k, seen = np.diff(np.append(first, len(head))), np.add.reduceat(c, first).astype(np.int64)
        keys = head[order[first]]
        return _dealt(keys, bits, key=keys, k=k, seen=seen, gained=gained, covered=covered)

    def states(asks: pa.Table, known: pa.Table) -> pa.Table:
        keys, c, own_gain = _flats(known, "key", "c", "gained")
        asked, *parts = _flats(asks, "key", "k", "seen", "gained", "covered")
        at = np.searchsorted(keys, asked)
        k, seen, gained, covered = (np.bincount(at, x, len(keys)) for x in parts)
        n = c.astype(float)
        left = np.maximum(1 - (seen - k * DISCOUNT) / n, 1e-12)
        backoff = np.log(left) - np.log(np.maximum(1 - covered, 1e-12))
        divergence = gained - seen * np.log(n) + (n - seen) * backoff
        backoff[(k == 0) | ~(divergence > 0.5 * (k + 1) * np.log(n))] = np.nan
        bucket = (known if known.num_rows else asks).column("bucket")[0].as_py()
        own = _row({"origin": -1, "bucket": bucket}, key=keys, c=c, gained=own_gain, backoff=backoff)
        if not asks.num_rows:
            return own
        bounds = asks.column("key").combine_chunks().offsets
        none = pa.ListArray.from_arrays(pa.array(np.zeros(asks.num_rows + 1, np.int32)), pa.array([], pa.int64()))
        lists = {
            "key": none,
            "c": pa.ListArray.from_arrays(bounds, pa.array(c[at].view(np.int64))),
            "gained": none.cast(pa.list_(pa.float64())),
            "backoff": pa.ListArray.from_arrays(bounds, pa.array(backoff[at])),
        }
        return pa.concat_tables([own, pa.table({"origin": asks.column("origin"), "bucket": asks.column("bucket"), **lists})])

    def as_contexts(rows: pa.Table, answers: pa.Table) -> pa.Table:
        key, head, c, parent = _flats(rows, "key", "head", "c", "parent")
        n, backoff = _flats(answers, "c", "backoff", by="bucket")
        at = np.searchsorted(_distinct(head), head)
        own = np.log((c.astype(float) - DISCOUNT) / n[at].astype(float))
        state = ~np.isnan(backoff[at])
        gained = np.where(state, own - parent - backoff[at], 0.0)
        return _row({"bucket": rows.column("bucket")[0].as_py()}, key=key, c=c, gained=gained, chance=np.where(state, own, parent))

    asked = _asks(listed.select("bucket", "head", "c", "parent"), sums, ", k array<long>, seen array<long>, gained array<double>, covered array<double>")
    kind = "origin int, bucket int, key array<long>, c array<long>, gained array<double>, backoff array<double>"
    answers = _written(_cogrouped(asked, contexts.select("bucket", "key", "c", "gained"), states, kind), nodes_at)
    nodes = answers.where("origin = -1").select(F.lit(size).alias("size"), "bucket", "key", "c", "gained", "backoff")
    answers = answers.where("origin >= 0").select("origin", "bucket", "c", "backoff")
    kind = "bucket int, key array<long>, c array<long>, gained array<double>, chance array<double>"
    return nodes, _written(_cogrouped(listed, answers, as_contexts, kind, "origin"), contexts_at)


def grow(spark: SparkSession, counted, depth: int, bits: int, places: list[str]) -> tuple[DataFrame, int, int]:
    """The nodes ``(size, bucket, key, c, gained, backoff)`` of the tree, a row of arrays for each size and bucket; how many
    tokens it learnt from, and how many words. ``counted`` gives the counts of its runs and these two numbers; what it
    writes goes as soon as all is read. ``gained``: the log of a listed transition's chance over what its context says of it unlisted,
    0 if its context is no state. ``backoff``: the log of the factor on what the suffix says of unlisted symbols; NaN
    if the node is no state. They are written to ``places``, a folder for each size; nothing else is read for them.
    """
    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, c = (_flat(batch.column(x).slice(i, 1)) for x in ("key", "c"))
                end = np.flatnonzero(key == _END)
                # A text starts as often as one ends.
                key, c = np.insert(key, end + 1, np.uint64(_START)), np.insert(c, end + 1, c[end])
                row = _row({"bucket": batch.column("bucket")[i].as_py()}, key=key, c=c, gained=np.zeros(len(key)), chance=np.log(c.astype(float) + 0.5) - scale)
                yield from row.to_batches()

    nodes = []
    with scratch(spark):
        last = shared_folder(spark, "transitions")
        contexts_at = [shared_folder(spark, "contexts") for _ in range(depth)]
        with scratch(spark):
            found, n_tokens, n_words = counted()
            scale = float(np.log(n_tokens + 0.5 * (n_words + 1)))
            kind = "bucket int, key array<long>, c array<long>, gained array<double>, chance array<double>"
            contexts = map_arrow(found.where("size = 1").select("bucket", "key", "c"), roots, kind)
            if depth == 1:
                contexts = _written(contexts, contexts_at[0])
            for size in range(1, depth):
                with scratch(spark):
                    listed = _transitions(contexts, found.where(F.col("size") == size + 1), bits, shared_folder(spark, "transitions"))
                    of_size, contexts = _states(contexts, listed, size, bits, places[size - 1], contexts_at[size])
                nodes.append(of_size)
            listed = _transitions(contexts, found.where(F.col("size") == depth + 1), bits, last)
        of_size, contexts = _states(contexts, listed, depth, bits, places[depth - 1], places[depth])
    nodes.append(of_size)
    no_state = F.transform("gained", lambda x: F.lit(float("nan"))).alias("backoff")
    nodes.append(contexts.select(F.lit(depth + 1).alias("size"), "bucket", "key", "c", "gained", no_state))
    return reduce(DataFrame.unionAll, nodes), n_tokens, n_words


def _weights(nodes: DataFrame) -> DataFrame:
    """``(bucket, key, c, weight)``: what each run adds to the log of a text's chance, by key; all words, and other runs
    that add something. As each context is followed by a token, what it leaves to its suffix counts where it ends."""

    def packed(group: pa.Table) -> pa.Table:
        keys, c, gained, backoff = _flats(group, "key", "c", "gained", "backoff")
        lengths = group.column("key").combine_chunks().value_lengths().to_numpy()
        word = np.repeat(group.column("size").to_numpy() == 1, lengths)
        weight = gained + np.where(np.isnan(backoff), 0.0, backoff)
        at = np.flatnonzero(word | (weight != 0))
        at = at[_order(keys[at])]
        return _row({"bucket": group.column("bucket")[0].as_py()}, key=keys[at], c=np.where(word, c.view(np.int64), 0)[at], weight=weight[at])

    return nodes.groupBy("bucket").applyInArrow(packed, "bucket int, key array<long>, c array<long>, weight array<double>")


class Level(NamedTuple):
    """States of one length: their keys."""

    contexts: np.ndarray


class SuffixTree(NamedTuple):
    """All nodes by sorted key. Natural logarithms throughout."""

    keys: np.ndarray
    sizes: np.ndarray
    gained: np.ndarray
    #: NaN if the node is no state.
    backoff: np.ndarray
    depth: int

    @classmethod
    def of(cls, nodes: pa.Table, depth: int) -> SuffixTree:
        keys, gained, backoff = _flats(nodes, "key", "gained", "backoff")
        sizes = np.repeat(nodes.column("size").to_numpy(), nodes.column("key").combine_chunks().value_lengths().to_numpy())
        order = np.argsort(keys)
        return cls(keys[order], sizes[order], gained[order], backoff[order], depth)

    @property
    def levels(self) -> list[Level]:
        state = ~np.isnan(self.backoff)
        return [Level(self.keys[state & (self.sizes == m)]) for m in range(1, self.depth + 1)]

    def gain(self, t: Tokens) -> np.ndarray:
        """For each token, the log of its probability by the tree over that by the root."""
        r = runs(t, self.depth)
        out = np.zeros(len(r.place) + 1)
        for m, keys in enumerate(r.keys):
            inside = np.flatnonzero(r.place >= m)
            hit, at = _places(self.keys, keys[inside])
            np.add.at(out, inside[hit], self.gained[at])
            # A context's part goes to the token after it.
            np.add.at(out, inside[hit] + 1, np.nan_to_num(self.backoff[at]))
        return out[:-1][r.place > 0]


def train(docs: DataFrame, counts: DataFrame, n_tokens: int, n_words: int, depth: int = 2, least_share: float = 0.0) -> SuffixTree:
    """The whole tree of the texts of ``docs`` in the driver, given the counts of their tokens: for a small corpus.
    ``score`` never gathers it."""

    def packed(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group.column("key").to_numpy().view(np.uint64)))
        none = np.zeros(0, np.int64)
        return _row({"size": 1, "bucket": 0}, key=group.column("key").to_numpy(), head=none, tail=none, c=group.column("c").to_numpy())

    kind = "size int, bucket int, key array<long>, head array<long>, tail array<long>, c array<long>"
    least = max(LEAST, int(np.ceil(least_share * n_tokens)))
    single = counts.groupBy(F.lit(0).alias("bucket")).applyInArrow(packed, kind)

    def counted() -> tuple[DataFrame, int, int]:
        return single.unionAll(_counts(docs, 0, range(2, depth + 2), least)), n_tokens, n_words

    with scratch(docs.sparkSession):
        places = [shared_folder(docs.sparkSession, "nodes") for _ in range(depth + 1)]
        return SuffixTree.of(grow(docs.sparkSession, counted, depth, 0, places)[0].toArrow(), depth)


def score(
    df: DataFrame,
    held_out,
    text: str = "text",
    key: str = "doc_id",
    depth: int = 2,
    least_share: float = 0.0,
    chunk_bytes: int = CHUNK_BYTES,
    parts: int = PARTS,
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    The tree learns from rows whose ``held_out`` (a Boolean column) is not true. Tokens are the words
    ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case, then one end. ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))), ``score`` is the tree's log10 probability of the text. NULL
    and empty texts are an end alone. Other columns are left out; equal rows give equal rows, an empty
    table an empty one.
    """
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learn = docs.where(~F.col("held_out"))
    spark = df.sparkSession
    ship(spark)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = int(total // chunk_bytes) + 1
    parts = min(parts, chunks)
    count_parts = min(COUNT_PARTS, parts)
    # Tokens take some six bytes.
    bits = max(_bits(total // 6), (count_parts - 1).bit_length())
    folder = shared_folder(spark, "node-buckets")

    def counted() -> tuple[DataFrame, int, int]:
        least = LEAST
        if least_share:
            least = max(LEAST, int(np.ceil(least_share * (word_counts(learn).agg(F.sum("c")).first()[0] or 0))))
        found = _counts(learn, bits, range(1, depth + 2), least, count_parts)
        occurrences = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
        sums = found.where("size = 1").agg(F.sum(occurrences), F.sum(F.size("key"))).first()
        return found, *(x or 0 for x in sums)

    with scratch(spark):
        places = [shared_folder(spark, "nodes") for _ in range(depth + 1)]
        nodes, n_tokens, n_words = grow(spark, counted, depth, bits, places)
        nodes = _written(_weights(nodes), folder)
    release_shuffles(spark)
    base_scale = float(np.log10(n_tokens + 0.5 * (n_words + 1)))

    # Each chunk of documents asks for the nodes of its own runs of words.
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(chunks)).cast("int"))

    def asked(chunk: pa.Table) -> pa.Table:
        found = []
        for b in slices(iter(chunk.select(["text"]).to_batches()), "text"):
            r = runs(tokens(b.column(0)), depth)
            found += [_distinct(keys[r.place >= m]) for m, keys in enumerate(r.keys)]
        keys = _distinct(np.concatenate(found))
        dealt = _dealt(keys, bits, key=keys)
        number = chunk.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array(np.full(len(dealt["bucket"]), number, np.int32)), **dealt})

    def answered(asks: pa.Table, nodes: pa.Table) -> pa.Table:
        kinds = {"chunk": pa.int32(), "bucket": pa.int32(), "key": pa.list_(pa.int64()), "c": pa.list_(pa.int64()), "weight": pa.list_(pa.float64())}
        if not asks.num_rows or not nodes.num_rows:
            return pa.table({k: pa.array([], x) for k, x in kinds.items()})
        asks = asks.take(np.argsort(asks.column("chunk").to_numpy(), kind="stable")).combine_chunks()
        lengths = asks.column("key").combine_chunks().value_lengths().to_numpy()
        known, c, weight = _flats(nodes, "key", "c", "weight")
        hit, at = _places(known, _flat(asks.column("key")))
        of_row = np.diff(np.searchsorted(hit, np.append(0, np.cumsum(lengths))))
        chunk = np.repeat(asks.column("chunk").to_numpy(), of_row)
        if len(_firsts(asks.column("chunk").to_numpy())) < asks.num_rows:
            # A chunk in several groups asks several times.
            order = np.lexsort((at, chunk))
            chunk, at = chunk[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (chunk[1:] != chunk[:-1]) | (at[1:] != at[:-1])
            chunk, at = chunk[new], at[new]
        first = _firsts(chunk)
        bounds = pa.array(np.append(first, len(chunk)).astype(np.int32))
        lists = (pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (known[at].view(np.int64), c[at].view(np.int64), weight[at]))
        bucket = np.full(len(first), asks.column("bucket")[0].as_py(), np.int32)
        return pa.table([pa.array(chunk[first].astype(np.int32)), pa.array(bucket), *lists], list(kinds))

    def scored(chunk: pa.Table, known: pa.Table) -> pa.Table:
        known_keys, counts, weight = _flats(known, "key", "c", "weight", by="bucket")
        out: list[list] = [[], [], [], []]
        for batch in slices(iter(chunk.select(["text"]).to_batches()), "text"):
            t = tokens(batch.column(0))
            n = batch.num_rows
            r = runs(t, depth)
            inside = [np.flatnonzero(r.place >= m) for m in range(depth + 1)]
            keys, rows = (np.concatenate([x[at] for x, at in zip(of, inside)]) for of in (r.keys, [r.rows] * (depth + 1)))
            order = _order(keys)
            hit, at = _places(known_keys, keys[order])
            hit = order[hit]
            gain = np.bincount(rows[hit], weight[at], n)
            word = hit < len(r.place)
            c = np.zeros(len(r.place))
            c[hit[word]] = counts[at[word]]
            c = c[r.place > 0]
            base = np.bincount(t.rows, np.log10(c + 0.5) - base_scale, n)
            full = base + gain / np.log(10)
            for o, x in zip(out, (np.bincount(t.rows, minlength=n), np.bincount(t.rows[c > 0], minlength=n), base, full)):
                o.append(x)
        n_all, n_known, base, full = (np.concatenate(o) for o in out) if out[0] else [np.zeros(0)] * 4
        return pa.table(
            {
                "key": chunk.column("key"),
                "held_out": chunk.column("held_out"),
                "n_tokens": pa.array(n_all.astype(np.int64)),
                "n_known": pa.array(n_known.astype(np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(full),
            }
        )

    kind = df.schema[key].dataType.simpleString()
    # Equal rows share a chunk; one that they make too large is dealt to several groups, which all get the nodes of the chunk.
    sizes = dealt.groupBy("chunk").agg(F.ceil(F.sum(F.octet_length("text")) / chunk_bytes).cast("int").alias("groups"))
    hot = materialize(sizes.where(F.col("groups") > 2), "hot-chunks")
    split = hot.limit(1).count() > 0

    def grouped(rows: DataFrame, group: Column) -> DataFrame:
        if not split:
            return rows.withColumn("group", F.lit(0))
        return rows.join(hot, "chunk", "left").withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn("group", group).drop("groups")

    def done(part: int) -> DataFrame:
        mine = grouped(dealt.where(F.col("chunk") % parts == part), F.floor(F.rand(5) * F.col("groups")).cast("int"))
        asks = mine.groupBy("chunk", "group").applyInArrow(asked, "chunk int, bucket int, key array<long>")
        known = asks.groupBy("bucket").cogroup(nodes.groupBy("bucket")).applyInArrow(
            answered, "chunk int, bucket int, key array<long>, c array<long>, weight array<double>"
        )
        known = grouped(known, F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        return mine.groupBy("chunk", "group").cogroup(known.groupBy("chunk", "group")).applyInArrow(
            scored, f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        )

    whole = _in_turns(done, parts, "scores")
    return whole.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
