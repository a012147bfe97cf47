"""Fingerprints against the definition, covering against all pairs, components against brute force."""

import itertools
import random

import pytest
import xxhash

from llm_tables import SMALL, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import covering_masks, fingerprints, keep_one, links, near_duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_all_differences_within_the_radius(radius):
    bits = list(range(0, 24))
    masks = covering_masks(radius, bits)
    assert len(masks) == 2 ** (radius + 1) - 1
    for d in range(1, radius + 1):
        for where in itertools.combinations(bits, d):
            differ = sum(1 << b for b in where)
            assert any(not m & differ for m in masks)


def test_fingerprints(docs_of):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["The", "a", "É", "x\ty", "q"]) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    rows = [*enumerate(texts), (900, None), (901, ""), (902, " \n"), (903, "w " * 50_000), (903, "w " * 50_000)]
    got = fingerprints(docs_of(rows, ["fp"])).collect()
    assert sorted((r.doc_id, r.fp % 2**64) for r in got) == sorted((i, plain_fingerprint(t)) for i, t in rows)


@pytest.mark.parametrize("limit", [2, 5, 4096])
def test_links_lose_no_pair(spark, limit):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(60)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, limit)
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= 3]
    assert edges.count() < len(signed) * 15  # a forest in each bucket, not its pairs
    expected = plain_components(signed, pairs)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert {n: got.get(n, n) for n in signed} == expected


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    edges = [*chain, *star, (60, 61), (61, 60), (5, 5), (99, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    assert got == plain_components({n for e in linked for n in e}, linked)
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_near_duplicates_of_edge_rows(docs_of):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(3, None), (8, ""), (9, text), (4, text), (4, text), (None, text), (5, "other words entirely here now")]
    got = near_duplicates(docs_of(rows, ["fp", "root", "component"])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 4), (3, 3), (4, 4), (4, 4), (5, 5), (8, 3), (9, 4)]
    assert near_duplicates(docs_of([])).count() == 0
    assert [r.component_id for r in near_duplicates(docs_of([(None, text)])).collect()] == [None]


def test_keep_one(docs_of):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(9, text), (4, text), (4, text), (None, text), (None, "a single text of its own"), (None, "a single text of its own")]
    df = docs_of(rows, ["fp", "root"])
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(4, text), (0, "a single text of its own")])
    assert keep_one(docs_of([])).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    linked = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    expected = plain_components(fps, linked)
    rows = contract.queries()["op5_simhash"](spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", expected[i]) for i in fps}
    assert len(rows) == len(texts)
