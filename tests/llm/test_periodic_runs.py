"""Periodic runs against the definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_tables import MIDDLE, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.periodic_runs import find_runs, periodic_runs


def plain(seq):
    """[(start, length, period)] by looking at every diagonal."""
    n, out = len(seq), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if seq[i] != seq[i - q]:
                i += 1
                continue
            first = i
            while i < n and seq[i] == seq[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(6, 4 * q):
                out.setdefault((start, length), q)  # periods come in order, the smallest stays
    return sorted((s, length, q) for (s, length), q in out.items())


def collapsed(seq, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(seq) if i not in gone]


def found(seq):
    r = find_runs(np.array(seq, np.uint64))
    return list(zip(r.starts.tolist(), r.lengths.tolist(), r.periods.tolist()))


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_random_sequences(letters):
    rng = random.Random(letters)
    for _ in range(1500):
        seq = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, len(seq))
            seq[a:a] = [rng.randrange(letters) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7)
        assert found(seq) == plain(seq), seq


def test_shapes():
    assert found([]) == [] and found([1] * 5) == [] and found([1] * 6) == [(0, 6, 1)]
    assert found([1, 2] * 4) == [(0, 8, 2)] and found([1, 2] * 3 + [1]) == []
    assert found([1, 2, 3] * 4) == [(0, 12, 3)] and found(([1, 2, 3] * 4)[:-1]) == []
    fib = [0]
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    fib = b + b * 4
    assert found(fib) == plain(fib)
    blocks = ([7] * 30 + [8]) * 9 + ([7] * 12 + [9]) * 9
    assert found(blocks) == plain(blocks)


def test_a_long_repeat_of_one_word_takes_no_quadratic_time():
    assert found([5] * 300_000) == [(0, 300_000, 1)]
    assert found(list(range(50_000)) * 5) == [(0, 250_000, 50_000)]


def planted(doc_id, text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return ws
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    ws = planted(doc_id, text)
    runs = plain(ws)
    best = min(runs, key=lambda r: (-(r[1] * 10**12) // r[2], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *told, digest(lines), digest(" ".join(collapsed(ws, runs))))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_on_edge_rows(spark, docs_of, tmp_path):  # noqa: F811
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "x " * 20), (None, None), (5, "a b " * 9), (5, "a b " * 9), (6, "é " * 7 + "日本 😀 " * 8)]
    rows += [(k, " ".join(rng.choice(["a", "b", "c\x00", "\x1c", "Ab"]) for _ in range(rng.randint(0, 120)))) for k in range(10, 260)]
    hit = [k for k in range(1000, 1200) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows += [(hit[0], None), (hit[1], ""), (hit[2], " \n"), (hit[3], "one"), (hit[4], "one two"), (hit[5], "a b c d e f g")]
    rows += [(k, "word") for k in range(300, 330)]
    rows += [(700, "go " * 40_000), (701, "x y z " * 9 + "w" * 3_000_000)]
    docs_of(rows, extra=("runs", "_text", "_keep_0", "n_words")).write.parquet(f"{tmp_path}/documents.parquet")
    got = contract.queries()["op13_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS).collect()
    brute = [r for r in rows if r[0] not in (700, 701)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got if r.doc_id not in (700, 701)), key=key) == sorted((expected(*r) for r in brute), key=key)
    long = {r.doc_id: r for r in got if r.doc_id in (700, 701)}
    assert (long[700].n_runs, long[700].length, long[700].period) == (1, 40_000, 1)
    assert (long[701].n_runs, long[701].length, long[701].period) == (1, 27, 3)


def test_query_on_a_given_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in contract.queries()["op13_periodic_runs"](spark, MIDDLE).select(*COLUMNS).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len(r.text or "") < 4000]
    assert len(short) > 500 and all(got[r.doc_id] == expected(r.doc_id, r.text) for r in short)


def test_operator(spark, docs_of):  # noqa: F811
    out = periodic_runs(docs_of([(1, "a b c d " * 4 + "e"), (2, None)]), keep=("doc_id", "source")).collect()
    assert {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words, r.source) for r in out} == {
        1: ([(0, 16, 4)], "a b c d e", 17, "a"),
        2: ([], "", 0, "a"),
    }
    assert periodic_runs(docs_of([]).select("doc_id", "text")).count() == 0
