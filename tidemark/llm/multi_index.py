"""Embedding near-duplicates by an inverted multi-index.

Each half of the unit vectors has a codebook of its own; the pairs of their codes form a grid of cells. A
query visits cells in the order of a lower bound of their distance (multi-sequence traversal over the
two sorted lists) up to a reach that is set for a target recall: of pairs right at the threshold that
differ in random directions, the target share is found; nearer pairs are found more surely. What the
visited cells hold is verified in double precision. A pair counts for both if either visits the other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_arrow, materialize
from tidemark.llm.components import connected_components

#: Vectors that the codebooks are fitted on at most, codes of a half at most, and vectors a cell should hold.
SAMPLE, MOST_CODES, CELL = 20_000, 1024, 256
#: Vectors that the reach is set with at most.
PROBES = 4000
#: Members and queries of a cell that meet in one task at most, on average.
MEMBERS, QUERIES = 2048, 8192


def _codebook(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's algorithm from a spread start; deterministic."""
    rng = np.random.default_rng(7)
    centres = [x[0]]
    gap = ((x - x[0]) ** 2).sum(1)
    while len(centres) < k and gap.max() > 0:
        centres.append(x[rng.choice(len(x), p=gap / gap.sum())])
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        counts = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``x`` to each centre."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of each row, and the least squared distance to any point whose nearest centre is another one.

    Such a point lies beyond the plane halfway between the two centres.
    """
    d = _distances(x, c)
    own = d.argmin(1)
    apart = np.sqrt(np.maximum(_distances(c, c), 1e-300))
    beyond = np.maximum(d - d[np.arange(len(x)), own][:, None], 0) / (2 * apart[own])
    beyond[np.arange(len(x)), own] = 0
    return own, beyond**2


def visited(left: np.ndarray, right: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells (i, j) in order of ``left[i] + right[j]`` up to ``reach``, by multi-sequence traversal."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    x, y = left[a].tolist(), right[b].tolist()
    heap, out = [(x[0] + y[0], 0, 0)], []
    while heap:
        bound, i, j = heapq.heappop(heap)
        if bound > reach:
            break
        out.append((int(a[i]), int(b[j])))
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _reach(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float, target: float) -> float:
    """The bound up to which a share ``target`` of pairs at the threshold see each other."""
    rng = np.random.default_rng(8)
    x, cut = x[:PROBES], books[0].shape[1]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.maximum(np.sqrt((aside * aside).sum(1, keepdims=True)), 1e-300)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * aside
    each = []
    for book, part in zip(books, (slice(None, cut), slice(cut, None))):
        home, _ = _bounds(y[:, part], book)
        each.append(_bounds(x[:, part], book)[1][np.arange(len(x)), home])
    # No pair within the threshold is further apart than this, so nothing beyond needs a visit.
    return min(float(np.quantile(each[0] + each[1], target)), 2 - 2 * threshold) + 1e-9


def _cells(books: tuple[np.ndarray, np.ndarray], reach: float):
    """Rows (node, v) to the cells that each visits, and the one that it is indexed in."""
    codes = len(books[1])
    cut = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            (own_a, left), (own_b, right) = _bounds(x[:, :cut], books[0]), _bounds(x[:, cut:], books[1])
            home = (own_a * codes + own_b).tolist()
            nodes, cells, homes = [], [], []
            for k, node in enumerate(batch.column(0).to_pylist()):
                near = [i * codes + j for i, j in visited(left[k], right[k], reach)]
                nodes += [node] * len(near)
                cells += near
                homes += [home[k]] * len(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(cells, pa.int32()), pa.array(homes, pa.int32())], ["node", "cell", "home"]
            )

    return run


def _links(threshold: float, books: tuple[np.ndarray, np.ndarray], reach: float):
    """Verify the queries against the members of each unit; the rows come sorted by unit.

    Returns a row for each query with links, ``n`` the rows it links to there, the same for members that
    do not visit such a query's home, and the edges of a forest over the links (``n`` 0): no pairs.
    """
    codes, cut = len(books[1]), books[0].shape[1]

    def verify(node: np.ndarray, copies: np.ndarray, member: np.ndarray, home: np.ndarray, x: np.ndarray):
        m, q = member, ~member
        if not m.any() or not q.any():
            return [], [], []
        near = x[q] @ x[m].T >= threshold
        near &= node[q][:, None] != node[m]
        hit = near.any(1)
        if not hit.any():
            return [], [], []
        near, asks, holds = near[hit], node[q][hit], node[m]
        src, dst, n = asks.tolist(), asks.tolist(), (near @ copies[m]).tolist()
        # Members that will not come upon these queries by themselves count them here.
        met = near.any(0)
        homes, of_query = np.unique(home[q][hit], return_inverse=True)
        (_, left), (_, right) = _bounds(x[m][met][:, :cut], books[0]), _bounds(x[m][met][:, cut:], books[1])
        comes = left[:, homes // codes] + right[:, homes % codes] <= reach
        extra = (near[:, met] & ~comes[:, of_query].T).T @ copies[q][hit]
        src += holds[met][extra > 0].tolist()
        dst += holds[met][extra > 0].tolist()
        n += extra[extra > 0].tolist()
        waiting = np.ones(len(asks), bool)
        while waiting.any():
            mine = np.zeros(len(asks), bool)
            mine[waiting.argmax()] = True
            seen, fresh = np.zeros(len(holds), bool), mine
            while fresh.any():
                new = near[fresh].any(0) & ~seen
                seen |= new
                fresh = near[:, new].any(1) & ~mine
                mine = mine | fresh
            waiting &= ~mine
            group = np.concatenate([asks[mine], holds[seen]])
            src += group.tolist()
            dst += [int(group.min())] * len(group)
            n += [0] * len(group)
        return src, dst, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            unit, node, copies, member, home = (
                np.concatenate([r.column(i).to_numpy(zero_copy_only=False) for r in rows]) for i in range(5)
            )
            x = np.concatenate([_matrix(r.column(5)) for r in rows])
            cuts = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
            out: list[list] = [[], [], []]
            for a, b in zip(cuts, cuts[1:]):
                for all_, own in zip(out, verify(node[a:b], copies[a:b], member[a:b], home[a:b], x[a:b])):
                    all_ += own
            return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["src", "dst", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != unit[0]:
                yield flush(held)
                held = []
            last = int(np.flatnonzero(unit != unit[-1])[-1]) + 1 if unit[0] != unit[-1] else 0
            if last:
                yield flush([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield flush(held)

    return run


def near_vectors(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    threshold: float = 0.95,
    target: float = 0.998,
    sample: int = SAMPLE,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Rows link if the cosine of their vectors is at least ``threshold``. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest key that links lead to, the own one included;
    ``kept`` says that it is the own key. Vectors that are NULL, empty or zero, or hold NULL or values that are not
    finite, link with nothing; vectors of different lengths do not link, and each length has an index and a run of its
    own. Vectors of one number link if their signs agree. Rows with equal vectors count as one vector with so many copies and link among themselves. A NULL key
    is nobody's smallest. Other columns are left out; an empty table gives no rows.

    The codebooks are fitted, and the reach is set for the recall ``target``, on at most ``sample``
    different vectors; every vector is indexed and asked.
    """
    single = df.schema[vector].dataType == T.ArrayType(T.FloatType(), df.schema[vector].dataType.containsNull)
    kind = "float" if single else "double"
    whole = df.select(F.col(key).alias("key"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")).cast(kind))) & F.exists("v", lambda c: c != 0)
    rows = whole.withColumn("fit", F.coalesce(finite, F.lit(False)))
    # Vectors of one number point one way or the other.
    pointing = F.when(F.size("v") == 1, F.transform("v", lambda c: F.signum(c).cast(kind))).otherwise(F.col("v"))
    rows = rows.withColumn("v", pointing).withColumn("node", F.when(F.col("fit"), F.xxhash64("v")))
    rows = materialize(rows.select("key", "v", "node", F.size("v").alias("d")), "vectors")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("key").alias("low"), F.first("v").alias("v"), F.first("d").alias("d"))
    nodes = materialize(nodes, "nodes")
    alone = rows.select("key", "node")
    sizes = sorted(r["d"] for r in nodes.select("d").distinct().collect())
    found = [_found(nodes.where(F.col("d") == d).drop("d"), d, threshold, target, sample) for d in sizes if d > 1]

    told = nodes.select("node", "copies", "low")
    if found:
        links = found[0]
        for other in found[1:]:
            links = links.union(other)
        counts = links.where("n > 0").groupBy("src").agg(F.sum("n").alias("n"))
        parts = connected_components(links.where("n = 0").select("src", "dst"))
        told = told.join(counts, F.col("node") == F.col("src"), "left").drop("src")
        told = told.join(parts.withColumnRenamed("node", "in"), F.col("node") == F.col("in"), "left").drop("in")
        told = told.withColumn("component", F.coalesce("component", "node"))
    else:
        told = told.withColumns({"n": F.lit(0).cast("long"), "component": F.col("node")})
    told = materialize(told, "vector-components")
    lowest = told.groupBy("component").agg(F.min("low").alias("component_id"))
    told = told.join(lowest, "component").select("node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    joined = alone.join(told, "node", "left")
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _found(nodes: DataFrame, d: int, threshold: float, target: float, sample: int) -> DataFrame:
    """Rows (src, dst, n) of ``_links`` for the different vectors ``nodes(node, copies, low, v)`` of ``d`` numbers."""
    n = nodes.count()
    fitted = _matrix(nodes.select("v", "node").orderBy("node").limit(sample).toArrow().column(0).combine_chunks())
    codes = int(min(MOST_CODES, max(2, (n / CELL) ** 0.5), max(1, len(fitted))))
    books = (_codebook(fitted[:, : d // 2], codes), _codebook(fitted[:, d // 2 :], codes))
    reach = _reach(fitted, books, threshold, target)
    asked = materialize(map_arrow(nodes.select("node", "v"), _cells(books, reach), "node long, cell int, home int"), "cells")

    # Split what meets in a cell into units of members times queries; the grid has at most MOST_CODES ** 2 cells.
    crowd = asked.groupBy("cell").agg(F.count_if(F.col("home") == F.col("cell")).alias("members"), F.count("*").alias("queries")).where("members > 0")
    crowd = crowd.select(
        "cell",
        F.ceil(F.col("members") / MEMBERS).cast("int").alias("blocks"),
        F.ceil(F.col("queries") / QUERIES).cast("int").alias("parts"),
    )
    vectors = nodes.select("node", "copies", "v")
    # A cell without members cannot answer; the grid's bound makes the broadcast safe.
    placed = asked.join(F.broadcast(crowd), "cell")
    block, part = F.pmod(F.xxhash64("node"), F.col("blocks")), F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.col("parts"))
    as_member = placed.where("home = cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node", F.xxhash64("cell", block.cast("int"), F.col("part").cast("int")).alias("unit"), F.lit(True).alias("member"), "home"
    )
    as_query = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", F.xxhash64("cell", F.col("block").cast("int"), part.cast("int")).alias("unit"), F.lit(False).alias("member"), "home"
    )
    meeting = as_member.union(as_query).join(vectors, "node").select("unit", "node", "copies", "member", "home", "v")
    dealt = meeting.repartition("unit").sortWithinPartitions("unit")
    return materialize(map_arrow(dealt, _links(threshold, books, reach), "src long, dst long, n long"), "vector-links")
