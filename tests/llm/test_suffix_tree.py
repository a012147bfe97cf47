"""Base scores against the formula; the tree's distributions and held-out scores."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import MIDDLE, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.common import write_table
from tidemark.llm.suffix_tree import _dealt, _flat, _order, score, tokens, train, word_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


def plain_tokens(text):
    return [*(w.encode().lower() for w in WORD.findall(text or "")), None]


def plain_base(rows):
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in plain_tokens(t))
    n, scale = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    out = {}
    for i, t in rows:
        own = plain_tokens(t)
        out[i] = (len(own), sum(w in counts for w in own), n, sum(math.log10(counts[w] + 0.5) - scale for w in own))
    return out


def test_tokens():
    found = tokens(pa.array(["The cat\tTHE", None, "", "É é"]))
    assert found.rows.tolist() == [0, 0, 0, 0, 1, 2, 3, 3, 3]
    assert found.hashes[0] == found.hashes[2] != found.hashes[1]
    assert (found.hashes[[3, 4, 5, 8]] == 1).all()
    assert found.hashes[6] != found.hashes[7]  # only A-Z is put in lower case


def test_query_base_and_held_out_score(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()]
    expected = plain_base(rows)
    got = contract.queries()["op2_suffix_tree"](spark, MIDDLE).collect()
    assert len(got) == len(rows)
    for r in got:
        n_tokens, n_known, n, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.score <= 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_distributions_sum_to_one(docs_of):
    """After every context, the chances of all training words and of one unknown word add up to 1."""
    texts = ["a b c a b d a b c", "b c a c b a a b c c", "a b c", "d d a b c d"] * 6
    docs = docs_of(enumerate(texts))
    counts = word_counts(docs)
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    tree = train(docs, counts, n, v, depth=2, least_share=1e-3)
    assert any(len(level.contexts) for level in tree.levels)
    scale = np.log(n + 0.5 * (v + 1))
    known = {int(r.key) % 2**64: r.c for r in counts.collect()}
    for context in ("", "a", "b", "c", "d", "a b", "b c", "c a", "d a", "c c", "unseen b"):
        total = 0.0
        for word in ("a", "b", "c", "d", None, "unknown"):
            text = context if word is None else f"{context} {word}".strip()
            t = tokens(pa.array([text]))
            at = len(t.hashes) - (1 if word is None else 2)
            c = known.get(int(t.hashes[at]), 0)
            total += math.exp(math.log(c + 0.5) - scale + tree.gain(t)[at])
        assert total == pytest.approx(1.0, abs=1e-9), context


def test_longer_contexts_help(docs_of):
    """What follows "x y" depends on the word before; only a context of two words can tell."""
    texts = ["p x q", "r x s"] * 40
    rows = [*enumerate(texts)]
    one, two = (
        {r.doc_id: r.score for r in score(docs_of(rows), F.lit(False), depth=d, least_share=1e-3).collect()} for d in (1, 2)
    )
    assert all(two[i] > one[i] + 0.2 for i in two)


def test_edge_rows(docs_of):
    long = "lorem ipsum dolor " * 40_000
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "one three"), (4, long)]
    got = score(docs_of(rows, ["key", "c", "chunk", "score"]), held_out(), chunk_bytes=1000).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3), (1, 1), (2, 1), (3, 3), (3, 3), (4, 120_001)]
    assert len({(r.doc_id, r.score) for r in got if r.doc_id == 3}) == 1
    assert score(docs_of([]), held_out()).count() == 0
    alone = score(docs_of([(1, "a b")]), F.lit(True)).collect()  # nothing to learn from
    assert alone[0].train_tokens == 0 and alone[0].n_known == 0 and alone[0].base_score == alone[0].score == 0


def test_a_context_seen_twice_counts_at_any_size(docs_of):
    """Of some five million tokens, "rare pair here" stands in two texts; what follows it is told by the context alone."""
    filler = " ".join(f"w{i % 997}" for i in range(50_000))
    rows = [*((i, filler) for i in range(100)), (100, "rare pair here"), (101, "rare pair here"), (102, "pair other"), (103, "here other")]
    got = {r.doc_id: r for r in score(docs_of(rows), F.lit(False)).collect()}
    assert got[100].train_tokens > 5_000_000
    assert got[100].score > got[100].base_score + 15  # log10: each of the last two words and the end is nearly certain


def test_equal_rows_are_dealt_to_several_groups(docs_of):
    """A third of all rows equal: their chunk is cut, and every row scores as it does in one chunk."""
    rows = [(i, f"the {i % 7} rivers and the {i % 5} roads of the town number {i}") for i in range(400)]
    rows += [(1000, "the same text for many rows, again and again")] * 200
    df = docs_of(rows)
    whole = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 9)) for r in score(df, held_out()).collect())
    cut = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 9)) for r in score(df, held_out(), chunk_bytes=1500, parts=2).collect())
    assert len(cut) == 600 and cut == whole


def test_the_tables_of_the_tree_go_before_texts_are_scored(spark, docs_of):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    got = score(docs_of([(i, f"one two three {i % 3}") for i in range(50)]), held_out())
    left = {re.sub(r"^tidemark-|-[0-9a-f]{12}$", "", x.name) for x in set(folder.iterdir()) - before}
    assert got.count() == 50 and left <= {"node-buckets", "hot-chunks", "scores"}


def test_buckets_hold_all_keys_in_order():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 500, dtype=np.uint64))
    for bits in (0, 1, 5, 12):
        dealt = _dealt(keys, bits, key=keys, twice=np.arange(500) * 2)
        assert dealt["bucket"].to_pylist() == sorted({int(k) >> (64 - bits) for k in keys})
        assert [int(k) >> (64 - bits) for k in keys] == [b for b, x in zip(dealt["bucket"].to_pylist(), dealt["key"].to_pylist()) for _ in x]
        assert (_flat(pa.chunked_array([dealt["key"]])) == keys).all()
    assert len(_dealt(keys[:0], 4, key=keys[:0])["bucket"]) == 0


def test_counted_runs_go_before_the_last_states(spark, docs_of, monkeypatch):
    """What is counted is read once for each size; neither it nor the transitions lie on disk while weights are written."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    there = {}

    def watched(df, path, **options):
        kind = [re.sub(r"^tidemark-|-[0-9a-f]{12}$", "", x.name) for x in set(folder.iterdir()) - before]
        there.setdefault(re.sub(r".*tidemark-|-[0-9a-f]{12}$", "", path), []).append(Counter(kind))
        return write_table(df, path, **options)

    monkeypatch.setattr("tidemark.llm.suffix_tree.write_table", watched)
    assert score(docs_of([(i, f"one two three {i % 3}") for i in range(50)]), held_out()).count() == 50
    assert set(there["node-buckets"][0]) == {"nodes"}
    assert set(there["nodes"][-1]) <= {"nodes", "contexts", "transitions"} and there["nodes"][-1]["transitions"] == 1


def test_order_of_keys_alike_but_for_their_lowest_bits():
    rng = np.random.default_rng(4)
    alike = np.uint64(1 << 60) + rng.integers(0, 8, 5000, dtype=np.uint64)
    for keys in (alike, np.concatenate([alike, rng.integers(0, 1 << 64, 5000, dtype=np.uint64)]), alike[:1], alike[:0]):
        order = _order(keys)
        assert sorted(order.tolist()) == list(range(len(keys))) and (keys[order] == np.sort(keys)).all()


def test_scores_are_those_of_the_whole_tree(docs_of):
    """The sum of weights fetched by chunk is what the tree in the driver says token by token."""
    texts = ["a b c a b d a b c", "b c a c b a a b c c", "a b c", "d d a b c d", "", "x a b unseen c"] * 6
    docs = docs_of(enumerate(texts))
    counts = word_counts(docs)
    tree = train(docs, counts, *counts.agg(F.sum("c"), F.count("*")).first())
    assert any(len(level.contexts) for level in tree.levels)
    for r in score(docs, F.lit(False), chunk_bytes=100, parts=2).collect():
        gain = tree.gain(tokens(pa.array([texts[r.doc_id]]))).sum() / math.log(10)
        assert r.score - r.base_score == pytest.approx(gain, abs=1e-9)
