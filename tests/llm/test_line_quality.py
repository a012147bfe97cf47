"""Line counts against plain Python, Viterbi against all paths, and accuracy on held-out labels."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from llm_tables import MIDDLE, SMALL, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.common import texts
from tidemark.llm.line_quality import COUNTS, LineField, _spread, describe, fit_field, judge, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words, seen, duplicates = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, duplicates, len(repeated)


def test_counts_of_random_texts():
    rng = random.Random(3)
    parts = ["a", "b", "é ", "\n", "\n", " ", "\t", "#", "$", "日本", "x y z w a b c d ", "\x0b", "\x1c", "\xa0", "| "]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [None, "", "\n", "\n\n", "a"]
    found = describe(texts(pa.array(rows)))
    got = list(zip(*(found.counts[c].tolist() for c in COUNTS)))
    assert got == [plain_counts(t) for t in rows]
    assert found.per_doc.tolist() == [len((t or "").split("\n")) for t in rows]


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    field = LineField(rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), np.zeros(3), np.ones(3))
    per_doc = np.array([3, 1, 6, 2, 6])
    features = rng.normal(size=(per_doc.sum(), 3))
    got, at = field.viterbi(features, per_doc), 0
    for n in per_doc:
        score = field.scores(features[at : at + n])

        def value(path):
            return sum(score[i, y] for i, y in enumerate(path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        assert value(got[at : at + n]) == pytest.approx(max(value(p) for p in itertools.product((0, 1), repeat=n)))
        at += n


def test_fitting_tells_separable_lines_apart():
    rng = np.random.default_rng(5)
    docs = [rng.normal(loc=c * 3, size=(rng.integers(1, 60), 2)) for c in (0, 1) for _ in range(30)]
    field = fit_field(docs, [False] * 30 + [True] * 30)
    labels = field.viterbi(np.concatenate(docs), np.array([len(d) for d in docs]))
    truth = np.concatenate([np.full(len(d), i >= 30) for i, d in enumerate(docs)])
    assert (labels == truth).mean() > 0.97


def mixed_docs(rng, n, share):
    """Documents of two kinds of lines; ``share`` of the lines of each are of the other kind, at its end."""
    docs, truth = [], []
    for c in (0, 1):
        for _ in range(n):
            size = int(rng.integers(6, 30))
            own = np.full(size, c)
            own[size - int(share * size) :] = 1 - c
            docs.append(rng.normal(loc=np.where(own, 2.5, -2.5)[:, None], size=(size, 2)))
            truth.append(own)
    return docs, np.concatenate(truth)


def test_labels_change_within_a_document():
    """The field only knows what documents are, and yet finds the lines of the other kind, and where they begin."""
    docs, truth = mixed_docs(np.random.default_rng(6), 60, 0.3)
    field = fit_field(docs, [False] * 60 + [True] * 60)
    labels = field.viterbi(np.concatenate(docs), np.array([len(d) for d in docs]))
    assert (labels == truth).mean() > 0.97
    # Labels stay more often than they change, but they do change.
    assert field.move[0, 0] > field.move[0, 1] and field.move[1, 1] > field.move[1, 0]


def test_prose_with_boilerplate_lines_has_both_labels(spark, docs_of):
    rng = random.Random(8)
    words = "the river town bridge council road market winter story people and of with over".split()
    line = lambda: f"{' '.join(rng.choice(words) for _ in range(rng.randint(9, 16))).capitalize()}, {rng.choice(words)}."
    menu = lambda: " | ".join(rng.choice(["Home", "News", "Sport", "About", "#1", "Login", "$ Shop"]) for _ in range(4))
    text = lambda lines: "\n".join(lines)
    rows = [(i, text([line() for _ in range(8)] + [menu() for _ in range(i % 3)])) for i in range(60)]
    rows += [(100 + i, text([menu() for _ in range(9)] + [line() for _ in range(i % 2)])) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, quality int")
    field = train(docs_of(rows), labels)
    both = [(1, text([line() for _ in range(6)] + [menu() for _ in range(4)])), (2, text([menu() for _ in range(12)] + [line(), line()])), (3, text([line() for _ in range(9)]))]
    got = {r.doc_id: r for r in judge(docs_of(both), field).collect()}
    assert 0.5 < got[1].content_share < 1 and got[1].kept
    assert 0 < got[2].content_share < 0.5 and not got[2].kept
    assert got[3].content_share == 1 and got[3].kept


def test_lines_of_given_documents_differ(spark):
    shares = [r.content_share for r in contract.queries()["op4_line_quality"](spark, MIDDLE).collect()]
    assert sum(0 < s < 1 for s in shares) > 50


def test_text_keys(spark, docs_of):
    rows = [(i, f"The {i}th line tells of rivers, and of bridges.\n" * 3 if i % 2 else f"# {i} | $ {i} | home\n" * 4) for i in range(20)]
    labels = spark.createDataFrame([(f"k{i}", i % 2) for i in range(20)], "doc_id string, quality int")
    named = docs_of(rows).selectExpr("'k' || doc_id AS doc_id", "text")
    field = train(named, labels)
    kept = {r.doc_id: r.content_share for r in judge(named, field).collect()}
    assert len(kept) == 20 and all(kept[f"k{i}"] == i % 2 for i in range(20))


def test_long_documents_are_fitted_on_in_part():
    lines = np.arange(40 * 70 * 2.0).reshape(-1, 2)
    part = _spread(lines)
    assert part.shape == (40 * 50, 2) and part[0, 0] == lines[0, 0] and part[-1, 0] == lines[-1, 0]
    assert _spread(lines[:1999]) is not None and len(_spread(lines[:1999])) == 1999


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    field = train(docs, labels.where("doc_id % 2 = 0"))
    rows = judge(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_edge_rows(docs_of, spark):
    fine = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, "\n"), (4, fine), (4, fine), (None, fine), (5, "w " * 100_000)]
    got = judge(docs_of(rows, ["kept", "n_words"]), None).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in got) == [
        (0, 40, False, True), (1, 0, True, False), (2, 0, True, False), (3, 0, True, False),
        (4, 40, False, True), (4, 40, False, True), (5, 100_000, True, False),
    ]
    assert judge(docs_of([]), None).count() == 0
    with pytest.raises(ValueError, match="prefix"):
        judge(docs_of(rows, ["kept"]), None, keep=("doc_id", "kept"))


def test_no_labels_no_field(docs_of, spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert train(docs_of([(1, "a b"), (2, None)]), none) is None
    assert train(docs_of([]), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")) is None


def test_query(spark):
    rows = contract.queries()["op4_line_quality"](spark, SMALL).collect()
    table = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    expected = {i: plain_counts(t) for i, t in zip(table["doc_id"], table["text"])}
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows} == expected
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_a_repeated_document_counts_once(spark, docs_of):
    texts_ = [f"The {i}th line tells of rivers, and of bridges.\nhome | news | {i}" for i in range(12)]
    rows = [*enumerate(texts_)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    once = train(docs_of(rows), labels)
    often = train(docs_of([*rows, *rows[3:4] * 400, *[(5, texts_[5])] * 50]), labels)
    for a, b in zip(once, often):
        assert np.array_equal(a, b)
    # Other texts of that id do not add to it either: one of them is taken.
    mixed = [train(docs_of([*rows[:3], *rows[4:], *((3, t) for t in more)]), labels) for more in (texts_[:9] * 30, texts_[8::-1])]
    for a, b in zip(*mixed):
        assert np.array_equal(a, b)
    # An id of both classes counts in each.
    both = labels.unionAll(labels.where("doc_id = 3").selectExpr("doc_id", "0 AS quality"))
    assert any(not np.array_equal(a, b) for a, b in zip(once, train(docs_of(rows), both)))
    # One text for it however often it stands there.
    for a, b in zip(train(docs_of(rows), both), train(docs_of([*rows, *rows[3:4] * 40]), both)):
        assert np.array_equal(a, b)
