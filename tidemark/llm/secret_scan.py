"""Secret scans: one deterministic automaton over bytes finds the matches of all rules in one pass.

Each rule's expression becomes a nondeterministic automaton, subset construction makes it deterministic
and partition refinement minimal. In the same way all of these become one, whose table tells after each
byte which rules have a match that ends there. Only at such ends a rule's own two automata run: the
reversed one back to the leftmost start, the plain one on to the longest end.

Many rules whose values overlap would need a state for each set of values that may be open. Their common
automaton forgets a match at the first place where it can end: that place tells all that is asked of it.
Rules that need too many states even so are dealt to several automata, each with a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter
from re import _constants as ops
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, slices, texts


class Rule(NamedTuple):
    """Matches of ``head`` followed by ``value``; those whose value is too short are dropped.

    Matches of a rule do not overlap: the leftmost comes first, dropped ones included. Expressions are
    built of ASCII characters, sets, groups, alternatives and repeats.
    """

    kind: str
    head: str
    value: str
    least_value: int = 1
    any_case: bool = False


#: The base rules, then those that this scan adds; spans are listed in this order.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 14),
    Rule("hex", r"", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN\x20", r"([A-Z]+\x20)?PRIVATE\x20KEY-----"),
    Rule("slack", r"xox[abprs]-", r"[0-9A-Za-z-]+", 10),
    Rule("temporary_access", r"ASIA", r"[A-Z0-9]+", 16),
    Rule("github", r"gh[opsru]_", r"[0-9A-Za-z]+", 36),
    Rule("github_fine", r"github_pat_", r"[0-9A-Za-z_]+", 60),
    Rule("gitlab", r"glpat-", r"[0-9A-Za-z_-]+", 20),
    Rule("google", r"AIza", r"[0-9A-Za-z_-]+", 35),
    Rule("stripe", r"(sk|rk)_(live|test)_", r"[0-9A-Za-z]+", 24),
    Rule("npm", r"npm_", r"[0-9A-Za-z]+", 36),
    Rule("sendgrid", r"SG\.", r"[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+", 60),
    Rule("web_token", r"eyJ[0-9A-Za-z_-]+\.eyJ", r"[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+", 20),
    Rule("bearer", r"bearer\x20+", r"[0-9a-z._~+/-]+=*", 20, True),
    Rule("login_in_url", r"[a-z]+://[0-9A-Za-z._~%-]+:", r"[^\x00-\x20\"'/:<>@]+@", 2),
)

#: States of a common automaton that knows every end of a match, and of one that knows first ends.
FEW_STATES, MOST_STATES = 1 << 10, 1 << 14


class _Nfa:
    """Edges on sets of bytes (256-bit masks) and edges on nothing."""

    def __init__(self):
        self.edges: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int, any_case: bool, backwards: bool) -> int:
        """Append the expression behind ``start``; the state it ends in."""
        for op, arg in reversed(list(tree)) if backwards else tree:
            if op in (ops.LITERAL, ops.NOT_LITERAL, ops.IN):
                mask = _mask(arg if op is ops.IN else [(ops.LITERAL, arg)], any_case)
                if op is ops.NOT_LITERAL:
                    mask ^= (1 << 256) - 1
                end = self.state()
                self.edges[start].append((mask, end))
            elif op is ops.SUBPATTERN:
                end = self.add(arg[-1], start, any_case, backwards)
            elif op is ops.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    self.free[self.add(branch, self.joined(start), any_case, backwards)].append(end)
            elif op is ops.MAX_REPEAT:
                least, most, inner = arg
                end = start
                for _ in range(least):
                    end = self.add(inner, end, any_case, backwards)
                if most is ops.MAXREPEAT:
                    loop = self.joined(end)
                    self.free[self.add(inner, loop, any_case, backwards)].append(loop)
                    end = self.joined(loop)
                else:
                    skips = [end]
                    for _ in range(most - least):
                        skips.append(self.add(inner, skips[-1], any_case, backwards))
                    end = self.state()
                    for s in skips:
                        self.free[s].append(end)
            else:
                raise ValueError(f"Rules cannot use {op}.")
            start = end
        return start

    def joined(self, start: int) -> int:
        end = self.state()
        self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, front = set(states), list(states)
        while front:
            for t in self.free[front.pop()]:
                if t not in found:
                    found.add(t)
                    front.append(t)
        return frozenset(found)


def _mask(items, any_case: bool) -> int:
    mask, negate = 0, False
    for op, arg in items:
        if op is ops.NEGATE:
            negate = True
            continue
        low, high = (arg, arg) if op is ops.LITERAL else arg if op is ops.RANGE else (256, 256)
        if high > 127:
            raise ValueError("Rules consist of ASCII characters and sets of them.")
        for c in map(chr, range(low, high + 1)):
            for x in {c, c.lower(), c.upper()} if any_case else {c}:
                mask |= 1 << ord(x)
    return mask ^ ((1 << 256) - 1) if negate else mask


class Automaton(NamedTuple):
    """``rows[state, class_of[byte]]`` is the next state; ``sets[accepts[state]]`` are the rules that end there.

    State 0 starts. ``sets[0]`` is empty.
    """

    rows: np.ndarray
    accepts: np.ndarray
    class_of: np.ndarray
    sets: list[frozenset[int]]

    @property
    def table(self) -> np.ndarray:
        return self.rows[:, self.class_of]


class TooManyStates(Exception):
    """A common automaton would have more states than it may."""


def _determine(nfa: _Nfa, starts: list[int], ends: dict[int, int], anywhere: bool, most: int | None = None) -> Automaton:
    """Subset construction over classes of bytes, then minimisation. Sets of states are bit masks."""
    masks = sorted({m for edges in nfa.edges for m, _ in edges})
    member = np.array([[m >> b & 1 for m in masks] for b in range(256)])
    _, sample, class_of = np.unique(member, axis=0, return_index=True, return_inverse=True)
    closed = [sum(1 << t for t in nfa.closure([s])) for s in range(len(nfa.edges))]
    begin = 0
    for s in starts:
        begin |= closed[s]
    # Where each state leads on each class of bytes.
    steps = []
    for byte in sample.tolist():
        step = [0] * len(nfa.edges)
        for s, edges in enumerate(nfa.edges):
            for m, t in edges:
                if m >> byte & 1:
                    step[s] |= closed[t]
        steps.append(step)
    live = sum(1 << s for s, edges in enumerate(nfa.edges) if edges or s in ends)
    begin &= live
    known, queue, rows = {begin: 0}, [begin], []
    for subset in queue:
        if most and len(queue) > most:
            raise TooManyStates
        members = [i for i in range(subset.bit_length()) if subset >> i & 1]
        row = []
        for step in steps:
            target = begin if anywhere else 0
            for s in members:
                target |= step[s]
            target &= live
            if target not in known:
                known[target] = len(queue)
                queue.append(target)
            row.append(known[target])
        rows.append(row)
    sets = {frozenset(): 0}
    accepts = [sets.setdefault(frozenset(k for s, k in ends.items() if subset >> s & 1), len(sets)) for subset in queue]
    return _minimal(np.array(rows), np.array(accepts), class_of.ravel(), list(sets))


def _minimal(rows: np.ndarray, accepts: np.ndarray, class_of: np.ndarray, sets: list[frozenset[int]]) -> Automaton:
    """Merge states that no input tells apart, by refining the partition by accepted rules."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    # Number the blocks so that the start's is 0.
    order = np.zeros(block.max() + 1, int)
    rest = [b for b in range(len(order)) if b != block[0]]
    order[[block[0], *rest]] = np.arange(len(order))
    block = order[block]
    some = np.zeros(len(order), int)
    some[block] = np.arange(len(block))
    return Automaton(block[rows[some]].astype(np.int32), accepts[some], class_of, sets)


def _automaton(expressions: list[tuple[str, bool]], backwards: bool = False) -> Automaton:
    nfa, starts, ends = _Nfa(), [], {}
    for i, (expression, any_case) in enumerate(expressions):
        starts.append(nfa.state())
        ends[nfa.add(_parser.parse(expression), starts[-1], any_case, backwards)] = i
    return _determine(nfa, starts, ends, False)


def _common(plain: dict[int, Automaton], first: bool, most: int | None) -> Automaton:
    """One automaton for matches of any of these rules anywhere: where they end, or where each could ``first`` end."""
    nfa, starts, ends = _Nfa(), [], {}
    for k, a in plain.items():
        table, states = a.table, [nfa.state() for _ in a.accepts]
        # A start of its own, which is no end: empty matches do not count.
        starts.append(nfa.state())
        ends |= {states[s]: k for s in np.flatnonzero(a.accepts).tolist()}
        alive, size = a.accepts > 0, -1
        while size < (size := int(alive.sum())):
            alive = alive | alive[a.rows].any(1)
        on = np.flatnonzero(alive & ~(first & (a.accepts > 0))).tolist()
        for state, s in [(starts[-1], 0), *((states[s], s) for s in on)]:
            for t in set(table[s].tolist()):
                if alive[t]:
                    nfa.edges[state].append((sum(1 << b for b in np.flatnonzero(table[s] == t).tolist()), states[t]))
    return _determine(nfa, starts, ends, True, most)


def _scans(plain: dict[int, Automaton]) -> list[Automaton]:
    for first, most in ((False, FEW_STATES), (True, MOST_STATES if len(plain) > 1 else None)):
        try:
            return [_common(plain, first, most)]
        except TooManyStates:
            pass
    half = len(plain) // 2
    items = list(plain.items())
    return _scans(dict(items[:half])) + _scans(dict(items[half:]))


class Compiled(NamedTuple):
    """The automata of some rules: common ones, anywhere, and of each the whole, the whole backwards, and the head."""

    scans: list[Automaton]
    plain: list[Automaton]
    back: list[Automaton]
    head: list[Automaton]

    @property
    def scan(self) -> Automaton:
        """The common automaton of all rules, if one is enough."""
        (only,) = self.scans
        return only


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Compiled:
    if not rules:
        raise ValueError("A scan takes at least one rule.")
    whole = [(r.head + r.value, r.any_case) for r in rules]
    plain = [_automaton([w]) for w in whole]
    return Compiled(
        _scans(dict(enumerate(plain))),
        plain,
        [_automaton([w], backwards=True) for w in whole],
        [_automaton([(r.head, r.any_case)]) for r in rules],
    )


class Scanner:
    """Runs the automata of the rules."""

    def __init__(self, rules: tuple[Rule, ...], automata: Compiled):
        self.rules = rules
        # The first state of each common automaton, and of each of its rules, which of the sets hold it.
        self._scans = [(self._linked(a), {k: np.array([k in held for held in a.sets]) for k in sorted(set().union(*a.sets))}) for a in automata.scans]
        self._plain, self._back, self._head = ([self._walk(a) for a in x] for x in automata[1:])

    @staticmethod
    def _linked(a: Automaton) -> list:
        """Each state is a list of the states that follow, and at 256 the number of the set of rules that end in it."""
        states: list[list] = [[] for _ in a.accepts]
        for state, row, accepted in zip(states, a.table, a.accepts.tolist()):
            state.extend([states[t] for t in row.tolist()])
            state.append(accepted)
        return states[0]

    @staticmethod
    def _walk(a: Automaton):
        table, accepts = a.table.tolist(), a.accepts.tolist()
        dead = [s for s, row in enumerate(table) if set(row) == {s} and not accepts[s]]
        dead = dead[0] if dead else -1

        def longest(data: bytes, at: int, stop: int, step: int) -> int | None:
            """The last place up to ``stop`` where a match that starts at ``at`` ends; ``step`` -1 goes back."""
            state, found = 0, at if accepts[0] else None
            while at != stop:
                state = table[state][data[at if step > 0 else at - 1]]
                at += step
                if accepts[state]:
                    found = at
                elif state == dead:
                    break
            return found

        return longest

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes, by start, then rule."""
        out = []
        for begin, holds in self._scans:
            ended = map(itemgetter(256), accumulate(data, getitem, initial=begin))
            few = all(len(held) <= 256 for held in holds.values())
            codes = np.frombuffer(bytes(ended), np.uint8) if few else np.fromiter(ended, np.int32, len(data) + 1)
            hits = np.flatnonzero(codes)
            for k, held in holds.items() if len(hits) else ():
                out += self._matches(k, data, hits[held[codes[hits]]])
        return sorted(out, key=lambda x: (x[1], x[0]))

    def _matches(self, k: int, data: bytes, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Of rule ``k``, given the places where its matches end, or could first end."""
        free = i = 0
        while i < len(ends):
            start = self._back[k](data, int(ends[i]), free, -1)
            if start is None or start == ends[i]:
                i += 1
                continue
            free = self._plain[k](data, start, len(data), 1)
            if free - self._head[k](data, start, free, 1) >= self.rules[k].least_value:
                yield k, start, free
            i = int(np.searchsorted(ends, free, "right"))


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...], automata: Compiled | None = None) -> Scanner:
    """The scanner of this process for ``rules``."""
    if rules not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[rules] = Scanner(rules, automata or compiled(rules))
    return _SCANNERS[rules]


def find_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``spans``, an array of (kind, start, end) by start, then by order of rules.

    Places are code points of the whole text, the end exclusive. NULL and empty texts have no spans.
    Other columns are left out, also one called ``spans``; equal rows give equal rows, an empty table an
    empty one. No shuffle.
    """
    source = df.select(*keep, F.col(text).alias("_text"))
    span = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("spans", T.ArrayType(span, False), False)])
    rules = tuple(rules)
    automata = compiled(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules, automata)
        for batch in slices(batches, "_text"):
            t = texts(batch.column(batch.num_columns - 1))
            whole, bounds = t.data.tobytes(), t.offsets.tolist()
            sizes, kinds, starts, ends = [0], [], [], []
            for a, b in zip(bounds, bounds[1:]):
                data = whole[a:b]
                found = scan.spans(data)
                sizes.append(len(found))
                if found:
                    point = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                    kinds += [rules[k].kind for k, _, _ in found]
                    starts += point[[s for _, s, _ in found]].tolist()
                    ends += point[[e for _, _, e in found]].tolist()
            fields = [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
            spans = pa.ListArray.from_arrays(
                pa.array(np.cumsum(sizes), pa.int32()), pa.StructArray.from_arrays(fields, ["kind", "start", "end"])
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], spans], schema.names)

    return map_arrow(source, run, schema)
