"""Links and components of vectors against all pairs."""

import numpy as np
import pytest

from llm_tables import SMALL

import __spark_entry__ as contract
from tidemark.llm.multi_index import _bounds, _codebook, near_vectors, visited


def plain(rows, threshold=0.95):
    """{key: (n_links, component)} for (key, vector) with each key once."""
    good = {k: np.array(v, float) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    near = {k: {j for j in good if j != k and _cos(good[k], good[j]) >= threshold} for k in good}
    out = {}
    for k, _ in rows:
        seen, front = {k}, [k]
        while front:
            for j in near.get(front.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    front.append(j)
        out[k] = (len(near.get(k, ())), min(seen))
    return out


def _cos(a, b):
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return a @ b / np.sqrt((a @ a) * (b @ b))


def vectors(spark, rows):
    return spark.createDataFrame([(k, v) for k, v in rows], "vec_id long, embedding array<double>").repartition(3)


def test_clusters_chains_and_copies(spark):
    rng, rows = np.random.default_rng(14), []
    for _ in range(12):
        centre = rng.normal(size=8)
        for _ in range(rng.integers(1, 25)):
            rows.append(centre * rng.uniform(0.1, 10) + rng.normal(size=8) * rng.choice([0, 0.05, 0.3]))
    a, b = rng.normal(size=(2, 8))
    rows += [a * np.cos(t) + b * np.sin(t) for t in np.arange(0, 3, 0.2)]
    keyed = [(int(k), v.tolist()) for k, v in zip(rng.permutation(len(rows)), rows)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(vectors(spark, keyed)).collect()}
    assert got == plain(keyed)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 1.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, []), (7, [1.0, 2.0]), (9, v), (8, v)]
    df = vectors(spark, [*rows, (None, v), (10, [1e-200, 2e-200, 3e-200]), (11, [1e200, 2e200, 3e200])])
    out = near_vectors(df.selectExpr("*", "1 AS n_links", "'x' AS node", "0 AS cell")).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert len(out) == 12
    assert all(got[k] == (0, k, True) for k in range(1, 8))
    assert got[8] == (4, 8, True) and got[9] == (4, 8, False)
    assert got[None] == (4, 8, False) and got[10] == (4, 8, False) and got[11] == (4, 8, False)
    assert near_vectors(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in near_vectors(vectors(spark, [(3, None)])).collect()] == [(3, 0, 3, True)]


def test_traversal_visits_cells_in_order_and_all_that_can_hold_a_link():
    rng = np.random.default_rng(15)
    left, right = rng.random(9), rng.random(7)
    cells = visited(left, right, 0.8)
    bounds = [left[i] + right[j] for i, j in cells]
    assert bounds == sorted(bounds)
    assert set(cells) == {(i, j) for i in range(9) for j in range(7) if left[i] + right[j] <= 0.8}


def test_bounds_hold():
    rng = np.random.default_rng(16)
    x = rng.normal(size=(300, 4))
    book = _codebook(x, 12)
    own, least = _bounds(x, book)
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    for i in range(len(x)):
        assert (least[i][own] <= apart[i] + 1e-9).all()


@pytest.mark.parametrize("members, queries", [(3, 5), (2048, 8192)])
def test_query(spark, monkeypatch, members, queries):
    monkeypatch.setattr("tidemark.llm.multi_index.MEMBERS", members)
    monkeypatch.setattr("tidemark.llm.multi_index.QUERIES", queries)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = contract.queries()["op7_multi_index"](spark, SMALL).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_every_length_is_an_index_of_its_own(spark):
    """Pairs of vectors of two numbers among ones of three and five link; nothing links across lengths."""
    rng = np.random.default_rng(17)
    rows = [(k, rng.normal(size=3).tolist()) for k in range(40)] + [(100 + k, rng.normal(size=5).tolist()) for k in range(30)]
    rows += [(200, [1.0, 0.01]), (201, [1.0, 0.02]), (202, [-1.0, 0.0]), (203, [1.0, 0.02, 0.0])]
    rows += [(300, [2.0]), (301, [5.5]), (302, [-1e-300]), (303, [-7.0]), (304, [1e300]), (305, [0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(vectors(spark, rows)).collect()}
    want = {}
    for d in (1, 2, 3, 5):
        want |= plain([r for r in rows if len(r[1]) == d and any(r[1])])
    assert got == want | {305: (0, 305)}
    assert got[200] == (1, 200) and got[201] == (1, 200) and got[304] == (2, 300) and got[303] == (1, 302)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_of_one_number_alone(spark, kind):
    df = spark.createDataFrame([(2, [3.0]), (1, [0.5]), (4, [-2.0])], f"vec_id long, embedding array<{kind}>")
    assert {tuple(r) for r in near_vectors(df).collect()} == {(1, 1, 1, True), (2, 1, 1, False), (4, 0, 4, True)}
