"""Each stage on its own input against what its operator should have done, and the whole run."""

import base64
import itertools
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from llm_tables import SMALL, docs_of  # noqa: F401
from test_line_dedup import WORD, plain_dedup
from test_line_quality import plain_counts
from test_simhash import plain_components, plain_fingerprint

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm.common import materialize


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage read and returned."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        done = materialize(stage(spark, docs, SMALL), "stage")
        out.append((name, docs, done))
        docs = done
    return out


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality(spark, stages):
    _, before, after = stages[0]
    texts, kept = rows_of(before), rows_of(after)
    failed = set()
    for i, t in texts.items():
        n, _, _, _, repeats = plain_counts(t)
        if n < 20 or 100 * repeats > 30 * n:
            failed.add(i)
    assert not failed & kept.keys()
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()} - failed
    assert len(good & kept.keys()) >= 0.95 * len(good)
    assert all(texts[i] == t for i, t in kept.items())


def test_lines(stages):
    _, before, after = stages[1]
    expected = {i: t for i, t in plain_dedup(list(rows_of(before).items())).items() if WORD.search(t or "")}
    assert rows_of(after) == expected


def test_near_duplicates(stages):
    _, before, after = stages[2]
    texts = rows_of(before)
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    keep = {i for i, root in plain_components(fps, pairs).items() if i == root}
    assert rows_of(after) == {i: texts[i] for i in keep}
    assert after.count() == len(keep)


def test_mix(stages):
    _, before, after = stages[3]
    size = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in before.collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert max(copies.values()) <= 2
    taken, whole = defaultdict(int), defaultdict(int)
    for i, (source, n) in size.items():
        taken[source] += n * copies[i]
        whole[source] += n
    assert sum(taken.values()) == pytest.approx(1.5 * sum(whole.values()), rel=0.1)
    assert all(taken[s] <= 2 * whole[s] for s in whole)


def test_tokens(stages):
    _, before, after = stages[4]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    peer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = rows_of(before)
    assert Counter(r.doc_id for r in after.collect()) == Counter(r.doc_id for r in before.collect())
    for r in after.collect():
        assert r.token_ids == peer.encode_ordinary(texts[r.doc_id])


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = contract.queries()["pipeline"](spark, SMALL)
    last = stages[-1][2]
    assert got.columns == last.columns
    assert Counter((r.doc_id, r.ids_sha256) for r in got.collect()) == Counter((r.doc_id, r.ids_sha256) for r in last.collect())


def test_stages_take_odd_tables(spark, docs_of):
    fine = " ".join(f"word{i}" for i in range(40))
    for rows in ([], [(1, None, None), (2, "", "a"), (None, fine), (None, fine), (3, "x " * 50_000, "b")]):
        docs = docs_of(rows, ["kept", "fp", "size", "id"])
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SMALL), "stage")
        assert docs.count() <= 2 * len(rows)
