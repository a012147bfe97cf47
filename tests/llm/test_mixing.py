"""Targets against plain water-filling, what the mix takes against SQL and against its targets."""

import random
from collections import defaultdict

import duckdb
import pytest
from llm_tables import MIDDLE, docs_of  # noqa: F401
from oracle import assert_same, connect
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.llm.mixing import mix_sources, take, targets


def plain_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out = share * sum(sizes.values()), {}
    while len(out) < len(names):
        rest = [s for s in names if s not in out]
        level = left / sum(weight[s] for s in rest)
        full = [s for s in rest if level * weight[s] > most * sizes[s]]
        for s in full or rest:
            out[s] = most * sizes[s] if full else level * weight[s]
        left -= sum(most * sizes[s] for s in full)
    return out


def test_targets(spark):
    rng = random.Random(10)
    for _ in range(6):
        names = [*(f"s{i}" for i in range(rng.randint(1, 9))), None, "é", "Z"]
        sizes = {s: rng.choice([0, rng.randint(1, 50), rng.randint(1, 5000)]) for s in names}
        rows = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), [3, 1, 2], 1.5, 2.0).collect()
        assert {r.source: r.target for r in rows} == pytest.approx(plain_targets(sizes, [3, 1, 2], 1.5, 2.0))


def test_mix_comes_near_its_targets(docs_of):
    rng = random.Random(11)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a"] * 6 + ["b", "c", None])) for i in range(3000)]
    df = docs_of(rows, ["size", "hash", "target", "s"])
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 40
    again = {r.doc_id: r.copies for r in mix_sources(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    rows_out = take(df)
    assert rows_out.columns == df.columns
    assert rows_out.count() == sum(r.copies for r in got)


def test_edge_rows(docs_of):
    long = "w " * 200_000
    rows = [(1, None, None), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, long, "b"), (4, "z", "b")]
    got = mix_sources(docs_of(rows)).collect()
    assert len(got) == 6
    assert {r.size for r in got} == {0, 2, 200_000, 1}
    assert mix_sources(docs_of([])).count() == 0
    assert take(docs_of([(1, None, None), (2, "", "a")])).count() == 0


@pytest.mark.parametrize("extra", [None, ["url"]])
def test_equal_rows_are_split_at_the_threshold(spark, docs_of, tmp_path, extra):
    """Twelve sources of a hundred rows, forty of them equal; every target is met within one row."""
    rows = [(s * 1000 + (0 if i < 40 else i), "ten words " * 5 if i < 40 else f"{i} words " * 5, f"s{s:02}") for s in range(12) for i in range(100)]
    df = docs_of(rows, extra)
    got = mix_sources(df).collect()
    taken, target, copies = defaultdict(int), {}, defaultdict(list)
    for r in got:
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        copies[r.doc_id].append(r.copies)
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)
    assert any(len(set(c)) > 1 for c in copies.values())
    assert all(max(c) - min(c) <= 1 and max(c) <= 2 for c in copies.values())
    out = take(df).groupBy("doc_id", "source", "n_chars").count().collect()
    assert {r.doc_id: r["count"] for r in out} == {k: sum(c) for k, c in copies.items() if sum(c)}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert_same(contract.queries()["op9_mix_sources"](spark, str(tmp_path)), connect_folder(tmp_path), contract.oracle_sql()["op9_mix_sources"])


def connect_folder(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


def test_equal_keys_and_texts_in_rows_that_differ(spark, docs_of):
    """Rows that share key and text but not other columns are taken once more each at most."""
    df = docs_of([(1, "a few words", "a")] * 500 + [(2, "more words", "b")] * 3)
    df = df.withColumn("url", F.concat(F.lit("u"), F.monotonically_increasing_id() % 400))
    df = df.withColumn("tags", F.create_map(F.lit("k"), F.col("url")))
    given = {r.url: r["count"] for r in df.groupBy("url").count().collect()}
    plan = {r.source: r.target for r in mix_sources(df).select("source", "target").distinct().collect()}
    out = take(df).collect()
    words = sum(len(r.text.split()) for r in out if r.source == "a")
    assert abs(words - plan["a"]) <= 3
    seen = defaultdict(int)
    for r in out:
        seen[r.url] += 1
        assert r.tags == {"k": r.url}
    assert all(n <= 2 * given[u] for u, n in seen.items())


def test_query(spark):
    assert assert_same(contract.queries()["op9_mix_sources"](spark, MIDDLE), connect(MIDDLE), contract.oracle_sql()["op9_mix_sources"])
