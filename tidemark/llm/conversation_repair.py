"""Repair of the role order of conversations with the fewest edits, by Hirschberg's divide and conquer.

A repaired conversation has roles whose initials read ``(s?(ua)+)?``. Four states tell how far a prefix has come
(nothing, after ``s``, after ``u``, after ``a``). Each half of a conversation is summed up by four-state cost
vectors, one for each state it may be entered in; the forward vector of the left half and the backward vector of
the right half meet in the middle, and the crossing with the least cost, then the least audit, is taken. Each half
then has a known entry and exit, and the choice is repeated within it. Besides costs a half keeps the ranks of
its sixteen audits: audits of the same rows end with a row's own letter, so none is a prefix of another, and
ranks of halves compare audits of the whole. Nothing longer than the rows is held. Halves may lie in different
tasks, so a conversation of any length is solved in blocks, whose vectors meet first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import map_arrow, materialize

#: Rows of one conversation, and bytes of their texts, that a block holds at most (one row may be longer).
BLOCK_ROWS, BLOCK_BYTES = 8192, 1 << 22
#: What edits cost, and an undeleted truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
_NONE = 1 << 40
_SPACES = " \t\n\x0b\x0c\r"

# Where an initial leads from each state, and the initials that inserts add on the way from state to state.
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_ADDED = {(s, s): "" for s in range(4)} | {(0, 2): "u", (0, 3): "ua", (1, 2): "u", (1, 3): "ua", (2, 3): "a", (3, 2): "u"}
_INITIALS = "sua?"
#: Kinds of rows: initial (of ``_INITIALS``) times whole or truncated, rows that must go, and the end.
_GONE, _END = 8, 9


class Step(NamedTuple):
    """What happens to a row between two states: inserts, then the row's own letter."""

    cost: int
    audit: str
    added: str
    role: str | None


def _steps(kind: int, entry: int, leave: int) -> list[Step]:
    out = []
    for (start, state), added in _ADDED.items():
        if start != entry:
            continue
        cost, audit = INSERT * len(added), "I" * len(added)
        if kind == _END:
            if leave == 0 and state in (0, 3):
                out.append(Step(cost, audit, added, None))
            continue
        if state == leave:
            out.append(Step(cost + DELETE, audit + "D", added, None))
        if kind == _GONE:
            continue
        initial, more = _INITIALS[kind // 2], TRUNCATED * (kind % 2)
        if _AFTER.get(initial, {}).get(state) == leave:
            out.append(Step(cost + more, audit + "K", added, ""))
        out += [Step(cost + REROLE + more, audit + "R", added, role) for x, role in ROLES.items() if _AFTER[x].get(state) == leave]
    return out


#: The best step of each kind, entry and exit.
_STEP = [[[min(_steps(kind, s, t), key=lambda x: x[:2], default=None) for t in range(4)] for s in range(4)] for kind in range(10)]


def _ranked(keys: np.ndarray) -> np.ndarray:
    """How many of its row's entries are less than each (rows, 16)."""
    return (keys[:, :, None] > keys[:, None, :]).sum(2).astype(np.int64)


_COST = np.array([[[x.cost if x else _NONE for x in row] for row in kind] for kind in _STEP], np.int64)
_AUDITS = sorted({x.audit for kind in _STEP for row in kind for x in row if x})
_RANK = _ranked(np.array([[[_AUDITS.index(x.audit) if x else 0 for x in row] for row in kind] for kind in _STEP], np.int64).reshape(10, 16)).reshape(10, 4, 4)


class Sums(NamedTuple):
    """Costs and audit ranks from each entry to each exit, for parts of conversations (parts, 4, 4)."""

    cost: np.ndarray
    rank: np.ndarray


def _meet(left: Sums, right: Sums) -> tuple[Sums, np.ndarray]:
    """The sums of neighbours taken together, and the state they cross in."""
    cost = left.cost[:, :, :, None] + right.cost[:, None, :, :]
    order = left.rank[:, :, :, None] * 16 + right.rank[:, None, :, :]
    cross = (np.minimum(cost, _NONE) * 256 + order).argmin(2)
    pick = cross[:, :, None, :]
    cost = np.minimum(np.take_along_axis(cost, pick, 2)[:, :, 0], _NONE)
    order = np.take_along_axis(order, pick, 2)[:, :, 0]
    return Sums(cost, _ranked(order.reshape(-1, 16)).reshape(-1, 4, 4)), cross


def crossings(parts: Sums, sizes: np.ndarray, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, Sums]:
    """Entry and exit state of every part on the best way through its group, and the groups' sums.

    Groups have ``sizes`` parts each, one at least, laid end to end; they are entered and left in state 0, or as
    ``least`` (groups, 2) says. Halving goes by the places of parts, so that all groups are cut at once.
    """
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    levels = []
    while len(group) > len(sizes):
        paired = np.zeros(len(group), bool)
        paired[:-1] = (place[:-1] % 2 == 0) & (group[1:] == group[:-1])
        first = np.flatnonzero(place % 2 == 0)
        both = paired[first]
        met, cross = _meet(Sums(*(x[first[both]] for x in parts)), Sums(*(x[first[both] + 1] for x in parts)))
        above = Sums(*(x[first].copy() for x in parts))
        for whole, part in zip(above, met):
            whole[both] = part
        levels.append((first, both, cross))
        parts, group, place = above, group[first], place[first] // 2
    state = np.zeros((len(sizes), 2), np.int64) if least is None else least
    for first, both, cross in reversed(levels):
        below = np.zeros((len(first) + both.sum(), 2), np.int64)
        middle = cross[np.arange(len(cross)), state[both, 0], state[both, 1]]
        below[first] = state
        below[first[both], 1] = middle
        below[first[both] + 1, 0] = middle
        below[first[both] + 1, 1] = state[both, 1]
        state = below
    return state[:, 0], state[:, 1], parts


class Rows(NamedTuple):
    """Rows of conversations (or blocks of them) laid end to end; ``sizes`` rows each."""

    sizes: np.ndarray
    turns: pa.Array
    roles: pa.Array
    texts: pa.Array


class Faults(NamedTuple):
    initial: np.ndarray
    blank: np.ndarray
    again: np.ndarray
    cut: np.ndarray

    @property
    def kinds(self) -> np.ndarray:
        return np.where(self.blank | self.again, _GONE, 2 * self.initial + self.cut)


def _codes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def find_faults(rows: Rows, known: np.ndarray | None = None) -> Faults:
    """The first fault of each row; ``known`` tells rows that repeat one of an earlier block."""
    n = len(rows.roles)
    group = np.repeat(np.arange(len(rows.sizes)), rows.sizes)
    trimmed = pc.utf8_trim(rows.texts, characters=_SPACES)
    blank = (pc.binary_length(trimmed).to_numpy(zero_copy_only=False) == 0) if n else np.zeros(0, bool)
    roles, texts = _codes(rows.roles), _codes(rows.texts)
    pair = np.unique(roles * (int(texts.max(initial=0)) + 1) + texts, return_inverse=True)[1]
    first = np.unique(group * (int(pair.max(initial=0)) + 1) + pair, return_index=True)[1]
    again = np.ones(n, bool)
    again[first] = False
    if known is not None:
        again |= known
    ended = pc.or_(pc.or_(pc.ends_with(trimmed, "."), pc.ends_with(trimmed, "!")), pc.ends_with(trimmed, "?"))
    cut = ~ended.to_numpy(zero_copy_only=False).astype(bool)
    initial = np.full(n, 3)
    for i, x in enumerate(_INITIALS[:3]):
        initial[pc.starts_with(rows.roles, x).to_numpy(zero_copy_only=False).astype(bool)] = i
    return Faults(initial, blank, again & ~blank, cut & ~again & ~blank)


_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au


def _totals(rows: Rows, faults: Faults) -> dict[str, np.ndarray]:
    """Counts of each group: faults, illegal neighbours, and different turns with the first and last."""
    n = len(faults.initial)
    bounds = np.concatenate([[0], np.cumsum(rows.sizes)])
    inner = np.ones(n, bool)
    inner[bounds[:-1][bounds[:-1] < n]] = False
    illegal, fresh = np.zeros(n, bool), np.zeros(n, bool)
    turns = pc.fill_null(rows.turns, 0).to_numpy(zero_copy_only=False)
    told = pc.is_valid(rows.turns).to_numpy(zero_copy_only=False)
    if n:
        illegal[1:] = inner[1:] & ~_LEGAL[faults.initial[:-1], faults.initial[1:]]
        fresh = told.copy()
        fresh[1:] &= ~inner[1:] | ~told[:-1] | (turns[1:] != turns[:-1])

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    some = counted(told) > 0
    last = bounds[1:] - 1  # turns come sorted, NULL first
    lowest = bounds[1:] - counted(told)
    take = lambda at: np.where(some, turns[np.clip(at, 0, max(n - 1, 0))] if n else 0, 0)
    return {
        "blank": counted(faults.blank), "duplicate": counted(faults.again), "truncated": counted(faults.cut), "illegal": counted(illegal),
        "turns": counted(fresh), "low": take(lowest), "high": take(last),
    }


def _fixed(rows: Rows, kinds: np.ndarray, entry: np.ndarray, leave: np.ndarray, tails: list[str]) -> tuple[pa.Array, pa.Array]:
    """Audit and repaired rows of each group; ``tails`` are the initials that are added after the last row."""
    audit, out_roles, out_texts, ends = [], [], [], [0]
    roles, texts = rows.roles.to_pylist(), rows.texts.to_pylist()
    at = 0
    steps = [_STEP[k][s][t] for k, s, t in zip(kinds.tolist(), entry.tolist(), leave.tolist())]
    for size, tail in zip(rows.sizes.tolist(), tails):
        told = []
        for i in range(at, at + size):
            step = steps[i]
            told.append(step.audit)
            for x in step.added:
                out_roles.append(ROLES[x])
                out_texts.append("")
            if step.role is not None:
                out_roles.append(step.role or roles[i])
                out_texts.append(texts[i])
        for x in tail:
            told.append("I")
            out_roles.append(ROLES[x])
            out_texts.append("")
        at += size
        audit.append("".join(told))
        ends.append(len(out_roles))
    fixed = pa.StructArray.from_arrays([pa.array(out_roles, pa.string()), pa.array(out_texts, pa.string())], ["role", "text"])
    return pa.array(audit, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fixed)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = "array<struct<role: string, text: string>>"


def _solved(ids: pa.Array, blocks: np.ndarray, rows: Rows) -> list[pa.Array]:
    """Whole conversations: the columns of a piece, see ``repair``."""
    faults = find_faults(rows)
    kinds, totals = faults.kinds, _totals(rows, faults)
    sizes = rows.sizes + 1
    every = np.full(sizes.sum(), _END)
    inside = np.ones(len(every), bool)
    inside[np.cumsum(sizes) - 1] = False
    every[inside] = kinds
    entry, leave, sums = crossings(Sums(_COST[every], _RANK[every]), sizes)
    tails = [_STEP[_END][s][0].added for s in entry[~inside].tolist()]
    audit, fixed = _fixed(rows, kinds, entry[inside], leave[inside], tails)
    gaps = np.where(totals["turns"] > 0, totals["high"] - totals["low"] + 1 - totals["turns"], 0)
    counts = [gaps, *(totals[c] for c in COUNTS[1:-1]), sums.cost[:, 0, 0]]
    return [ids, pa.array(blocks), pa.array(np.ones(len(ids), np.int64)), *(pa.array(c, pa.int64()) for c in counts), audit, fixed]


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _key(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


_PIECE = f"block long, n_blocks long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired {_TURN}"
_OPEN = "rows array<struct<turn: long, role: string, text: string>>, firsts array<struct<key: binary, place: int>>"


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (id, turn, role, text, there) sorted by conversation and turn, to pieces.

    Conversations that lie within the task are solved; blocks of those that may go on elsewhere come with their rows.
    """
    number, block = TaskContext.get().partitionId() << 32, -1
    held: pa.Table | None = None
    opened = True  # the first conversation may have begun in an earlier task

    def emit(table: pa.Table, sizes: np.ndarray, whole: bool) -> pa.RecordBatch:
        nonlocal block
        ids, turns, roles, texts, there = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns)
        n = len(sizes)
        blocks = np.arange(block + 1, block + 1 + n) + number
        block += n
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        names = ids.take(pa.array(bounds[:-1]))
        sums = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
        rows = Rows(sums[bounds[1:]] - sums[bounds[:-1]], *(c.filter(there) for c in (turns, roles, texts)))
        if whole:
            columns = _solved(names, blocks, rows)
            columns += [pa.nulls(n, schema.field(i).type) for i in (len(columns), len(columns) + 1)]
        else:
            columns = [names, pa.array(blocks), *(pa.nulls(n, f.type) for f in list(schema)[2:-2])]
            columns.append(_lists(rows.sizes, pa.StructArray.from_arrays([rows.turns, rows.roles, rows.texts], ["turn", "role", "text"])))
            faults = find_faults(rows)
            first = np.flatnonzero(~faults.again & ~faults.blank)
            keys = [_key(r, t) for r, t in zip(rows.roles.take(pa.array(first)).to_pylist(), rows.texts.take(pa.array(first)).to_pylist())]
            of = np.searchsorted(np.cumsum(rows.sizes), first, "right")
            places = first - (np.cumsum(rows.sizes) - rows.sizes)[of]
            found = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(places, pa.int32())], ["key", "place"])
            columns.append(_lists(np.bincount(of, minlength=n), found))
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def full(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Blocks of a conversation that is too long for one."""
        nonlocal held
        size = pc.binary_length(table.column(3).combine_chunks()).to_numpy(zero_copy_only=False)
        while len(size) > BLOCK_ROWS or size.sum() > BLOCK_BYTES and len(size) > 1:
            n = int(min(BLOCK_ROWS, max(1, np.searchsorted(np.cumsum(size), BLOCK_BYTES, "right"))))
            yield emit(table.slice(0, n), np.array([n]), False)
            table, size = table.slice(n), size[n:]
        held = table

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        table = table.combine_chunks()
        codes = _codes(table.column(0).combine_chunks())
        edges = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        bounds = [0, *edges.tolist(), table.num_rows]
        done = bounds[:-1]  # conversations before the last are all there
        start = 0
        if opened and len(bounds) > 2:
            yield from full(table.slice(0, bounds[1]))
            yield emit(held, np.array([held.num_rows]), False)
            opened, start = False, 1
        if len(done) - 1 > start:
            sizes = np.diff(bounds)[start:-1]
            a = bounds[start]
            while len(sizes):
                # Some at a time, and each that is too long by itself in blocks.
                bytes_ = np.add.reduceat(pc.binary_length(table.column(3).combine_chunks()).to_numpy(zero_copy_only=False), a + np.cumsum(sizes) - sizes)
                long = (sizes > BLOCK_ROWS) | (bytes_ > BLOCK_BYTES) & (sizes > 1)
                n = int(long.argmax()) if long.any() else len(sizes)
                if n:
                    yield emit(table.slice(a, int(sizes[:n].sum())), sizes[:n], True)
                else:
                    n = 1
                    yield from full(table.slice(a, int(sizes[0])))
                    yield emit(held, np.array([held.num_rows]), False)
                a, sizes = a + int(sizes[:n].sum()), sizes[n:]
        left = table.slice(bounds[-2])
        before = left.num_rows
        yield from full(left)
        opened = opened or held.num_rows < before
    if held is not None:
        yield emit(held, np.array([held.num_rows]), False)


_SUMMARY = "id_block long, costs array<long>, ranks array<long>, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first int, last int, n long"


def _read(column: pa.Array) -> Rows:
    """The rows of a column of lists."""
    flat = column.flatten()
    return Rows(np.diff(column.offsets.to_numpy()), *(flat.field(i) for i in range(3)))


def _known(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Flags for the listed places of each block."""
    flags = np.zeros(sizes.sum(), bool)
    for start, places in zip((np.cumsum(sizes) - sizes).tolist(), column.to_pylist()):
        flags[[start + p for p in places or ()]] = True
    return flags


def _block_faults(batch: pa.RecordBatch) -> tuple[Rows, Faults]:
    rows = _read(batch.column(1))
    return rows, find_faults(rows, _known(batch.column(2), rows.sizes))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, faults = _block_faults(batch)
        totals, kinds = _totals(rows, faults), faults.kinds
        nothing = Sums(np.where(np.eye(4, dtype=bool), 0, _NONE)[None], np.zeros((1, 4, 4), np.int64))
        sums = Sums(*(np.repeat(x, batch.num_rows, 0) for x in nothing))
        some = rows.sizes > 0
        if some.any():
            _, _, got = crossings(Sums(_COST[kinds], _RANK[kinds]), rows.sizes[some])
            for whole, part in zip(sums, got):
                whole[some] = part
        bounds = np.cumsum(rows.sizes)
        edge = lambda at: np.where(some, faults.initial[np.clip(at, 0, max(len(kinds) - 1, 0))] if len(kinds) else 0, 0)
        columns = [batch.column(0), *(_lists(np.full(batch.num_rows, 16), pa.array(x.ravel())) for x in sums)]
        columns += [pa.array(totals[c], pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")]
        columns += [pa.array(edge(bounds - rows.sizes), pa.int32()), pa.array(edge(bounds - 1), pa.int32()), pa.array(rows.sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["id_block", "costs", "ranks", *(c.split()[0] for c in _SUMMARY.split(", ")[3:])])


_STATES = f"block long, entry int, leave int, tail string, n_blocks long, {', '.join(f'{c} long' for c in COUNTS)}"


def _joined(table: pa.Table) -> pa.Table:
    """The blocks of one conversation: entry and exit of each, and what the conversation has in all."""
    table = table.sort_by("id_block")
    n = table.num_rows
    col = {name: table.column(name).combine_chunks() for name in table.column_names}
    num = {c: col[c].to_numpy() for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last", "n")}
    end = Sums(_COST[[_END]], _RANK[[_END]])
    parts = Sums(*(np.concatenate([col[c].flatten().to_numpy().reshape(n, 4, 4), e]) for c, e in zip(("costs", "ranks"), end)))
    entry, leave, sums = crossings(parts, np.array([n + 1]))
    solid = np.flatnonzero(num["n"])
    illegal = num["illegal"].sum() + (~_LEGAL[num["last"][solid[:-1]], num["first"][solid[1:]]]).sum()
    told = np.flatnonzero(num["turns"])
    gaps = 0
    if len(told):
        turns = num["turns"].sum() - (num["high"][told[:-1]] == num["low"][told[1:]]).sum()
        gaps = num["high"][told[-1]] - num["low"][told[0]] + 1 - turns
    counts = [gaps, num["blank"].sum(), num["duplicate"].sum(), num["truncated"].sum(), illegal, sums.cost[0, 0, 0]]
    tails = [""] * (n - 1) + [_STEP[_END][int(entry[-1])][0].added]
    columns = [col["id_block"], pa.array(entry[:-1], pa.int32()), pa.array(leave[:-1], pa.int32()), pa.array(tails), pa.array([n] * n, pa.int64())]
    return pa.table(columns + [pa.array([int(c)] * n, pa.int64()) for c in counts], [c.split()[0] for c in _STATES.split(", ")])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their rows and states to pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, faults = _block_faults(batch)
        kinds, some = faults.kinds, rows.sizes > 0
        states = np.stack([batch.column(i).to_numpy() for i in (4, 5)], 1).astype(np.int64)
        entry = leave = np.zeros(0, np.int64)
        if some.any():
            entry, leave, _ = crossings(Sums(_COST[kinds], _RANK[kinds]), rows.sizes[some], states[some])
        audit, fixed = _fixed(rows, kinds, entry, leave, batch.column(6).to_pylist())
        columns = [batch.column(3), batch.column(0), *batch.columns[7:], audit, fixed]
        yield pa.RecordBatch.from_arrays(columns, ["id", "block", "n_blocks", *COUNTS, "audit", "repaired"])


def repair(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", there: Column | None = None
) -> DataFrame:
    """Pieces of repaired conversations: one row for most of them, and several blocks for long ones.

    Columns: the conversation; ``block``, which orders the pieces of one; ``n_blocks``; for the whole conversation,
    on each of its pieces, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal`` and ``cost``; and the piece's own
    ``audit`` and ``repaired`` (array of role and text). ``join_pieces`` makes one row of each conversation.

    Rows go by turn (NULL first), rows of one turn by role and a hash of the text; a NULL role or text is one space. A row's first
    fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated (the last visible
    character is not one of ``.!?``). Edits are Keep (0), Rerole to user or assistant (2), Delete (3; required
    for blank and duplicate rows) and Insert of an empty user or assistant row (2); a truncated row that is not
    deleted adds 1. The cheapest edits after which the role initials read ``(s?(ua)+)?`` are taken, of these the ones with
    the least audit (their initials in order). A role that is empty or begins otherwise cannot be kept.
    ``gaps`` are the whole numbers between the least and the greatest turn that are no turn; ``illegal`` counts neighbours
    whose initials are not ``su``, ``ua`` or ``au``.

    Rows for which ``there`` is not true only name their conversation: one without other rows has zeros, an empty audit and
    nothing repaired. A NULL conversation is one of its own; repeated rows are duplicates; other columns are left out; an
    empty table gives no rows. No task holds more than a block of a conversation, however long it is.
    """
    flag = F.lit(True) if there is None else F.coalesce(there, F.lit(False))
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    slim = df.select(F.col(conversation).alias("id"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"), flag.alias("there"))
    # Rows that are equal in everything are told apart, so that no range of the order is too large for a task.
    named = slim.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("copy"))
    order = ["id", "turn", "role", "hash", "copy"]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order).select(*slim.columns)
    kind = df.schema[conversation].dataType.simpleString()
    pieces = materialize(_cut_up(dealt, T.StructType.fromDDL(f"id {kind}, {_PIECE}, {_OPEN}")), "conversation-pieces")
    done = pieces.where("n_blocks IS NOT NULL").drop("rows", "firsts")
    opened = pieces.where("n_blocks IS NULL").select("id", "block", "rows", "firsts")

    # A row repeats one of an earlier block if its key has been seen there.
    keys = opened.select("id", "block", F.explode("firsts").alias("first")).select("id", "block", "first.key", "first.place")
    earliest = keys.groupBy("id", "key").agg(F.min("block").alias("earliest")).withColumnsRenamed({"id": "in", "key": "of"})
    again = keys.join(earliest, F.col("id").eqNullSafe(F.col("in")) & (F.col("key") == F.col("of"))).where("block > earliest")
    again = again.groupBy(F.col("block").alias("at")).agg(F.collect_list("place").alias("again"))
    marked = materialize(opened.join(again, F.col("block") == F.col("at"), "left").select("block", "rows", "again", "id"), "open-blocks")
    sums = map_arrow(marked.select("block", "rows", "again"), _summed, _SUMMARY).join(
        marked.select("id", F.col("block").alias("id_block")), "id_block"
    )
    states = materialize(sums.groupBy("id").applyInArrow(_conversation, _STATES), "conversation-states")
    whole = marked.join(states, "block").select("block", "rows", "again", "id", *states.columns[1:])
    rest = map_arrow(whole, _opened, f"id {kind}, {_PIECE}")
    return done.union(rest).withColumnRenamed("id", conversation)


def _cut_up(dealt: DataFrame, schema: T.StructType) -> DataFrame:
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _cut(batches, shape)

    return map_arrow(dealt, run, schema)


def _conversation(table: pa.Table) -> pa.Table:
    return _joined(table.drop_columns(["id"]))


def join_pieces(pieces: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row for each conversation: its counts, its whole ``audit`` and ``repaired_sha256``.

    The latter is the hash of the repaired rows as ``role:text``, joined by newlines, in lowercase hex. That of a
    conversation in several pieces runs over them one after the other, as a hash must; only a piece is held.
    """
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    slim = pieces.select(F.col(conversation).alias("id"), "block", "n_blocks", *COUNTS, "audit", F.size("repaired").alias("n"), lines.alias("lines"))
    single = slim.where("n_blocks = 1").select("id", *COUNTS, "audit", F.sha2("lines", 256).alias("repaired_sha256"))
    several = slim.where("n_blocks > 1").repartition("id").sortWithinPartitions("id", "block")
    kind = pieces.schema[conversation].dataType.simpleString()
    joined = map_arrow(several, _hashed, f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")
    return single.union(joined).withColumnRenamed("id", conversation)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (id, block, n_blocks, counts, audit, n, lines), sorted, to conversations."""
    audit: list[str] = []
    digest, filled = hashlib.sha256(), False
    for batch in batches:
        for i in range(batch.num_rows):
            # All pieces of a conversation come here one after the other, so their number tells the last one.
            *_, told, n, lines = (batch.column(k)[i].as_py() for k in range(batch.num_columns))
            audit.append(told)
            if n:
                digest.update((("\n" if filled else "") + lines).encode())
                filled = True
            if len(audit) == batch.column(2)[i].as_py():
                columns = [batch.column(0).slice(i, 1), *(batch.column(3 + k).slice(i, 1) for k in range(len(COUNTS)))]
                columns += [pa.array(["".join(audit)]), pa.array([digest.hexdigest()])]
                yield pa.RecordBatch.from_arrays(columns, ["id", *COUNTS, "audit", "repaired_sha256"])
                audit, digest, filled = [], hashlib.sha256(), False
