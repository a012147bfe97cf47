"""Nearest neighbours by largest inner product, approximately: multiprobe p-stable hashing.

Vectors are lifted to the unit sphere: each is divided by the power of two above its norm, and one component
makes up the rest of the length. Queries are unit vectors without that component, so a larger inner product
with vectors of like norm is a smaller distance. A table hashes by several random projections cut into slots
(Gaussian projections are 2-stable: near vectors have near projections). A query visits buckets in the order of
estimated success, which falls with the sum of the squares of what separates its projections from the slots'
edges, up to a reach that is fitted: of the true neighbours of sample queries, found by comparing these with all
vectors, the share ``target`` lies in a bucket within reach in some table. What the tables hold there is merged and
ranked by exact inner products in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, materialize, mix
from tidemark.llm.vectors import as_matrix, finite_vectors

#: Queries whose true neighbours are sought for the fit, and vectors that buckets are sized with, at most.
PROBES, SAMPLE = 128, 4096
#: What a fit chooses from: tables, projections of a table, slot widths.
TABLES, PROJECTIONS, WIDTHS = (2, 4), (2, 4, 6, 8), (0.75, 1.5)
#: Buckets of a table that a query may visit in a fit that is chosen, and vectors that one visit costs as much as.
MOST_VISITS, VISIT = 4000, 32
#: Members of a unit, queries of a unit, and members that a task holds at once, on average.
MEMBERS, QUERIES, REGION = 2048, 8192, 8192
#: Queries that a task ranks at once, and candidates it holds before it ranks them.
_CHUNK, _PENDING = 512, 1 << 20
#: Copies of the results that one vector's query rows are dealt over.
_DEALT = 16


class Hashing(NamedTuple):
    """``lines`` (tables, projections, dimension + 1) with the ``shift`` of their slots; how far queries look."""

    lines: np.ndarray
    shift: np.ndarray
    width: float
    reach: float


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors on the unit sphere, with one more component."""
    top = np.abs(x).max(1, keepdims=True)
    x = x / top * np.frexp(top)[0]  # without the power of two, so that no square overflows
    unit = x / np.exp2(np.ceil(np.log2(np.sqrt((x * x).sum(1, keepdims=True)))))
    return np.hstack([unit, np.sqrt(np.maximum(0.0, 1 - (unit * unit).sum(1, keepdims=True)))])


def pointed(x: np.ndarray) -> np.ndarray:
    """Queries as unit vectors without the added component."""
    x = x / np.abs(x).max(1, keepdims=True)
    return np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))])


def _gaps(place: np.ndarray, slot: np.ndarray, width: float) -> np.ndarray:
    """Squared distance of a shifted projection to a slot; 0 inside it."""
    return np.maximum(np.maximum(slot * width - place, place - (slot + 1) * width), 0) ** 2


def _bucket(table: int, summed: np.ndarray) -> np.ndarray:
    return mix(summed + np.uint64(2 * table + 1)).view(np.int64)


def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(3).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def places(hashing: Hashing, points: np.ndarray) -> np.ndarray:
    """Shifted projections (rows, tables, projections)."""
    return np.einsum("nd,tpd->ntp", points, hashing.lines, optimize=True) + hashing.shift


def homes(hashing: Hashing, points: np.ndarray) -> np.ndarray:
    """The bucket of each point in each table."""
    slots = np.floor(places(hashing, points) / hashing.width).astype(np.int64).view(np.uint64)
    summed = (slots * _factors(slots.shape[2])).sum(2, dtype=np.uint64)
    return np.stack([_bucket(t, summed[:, t]) for t in range(summed.shape[1])], 1)


def visits(hashing: Hashing, place: np.ndarray, table: int, most: int | None = None) -> np.ndarray | None:
    """The buckets within reach in order of estimated success; None if they are more than ``most``."""
    away, summed = np.zeros(1), np.zeros(1, np.uint64)
    for at, factor in zip(place, _factors(len(place))):
        side = np.sqrt(hashing.reach)
        slots = np.arange(np.floor((at - side) / hashing.width), np.floor((at + side) / hashing.width) + 1)
        away = (away[:, None] + _gaps(at, slots, hashing.width)).ravel()
        summed = (summed[:, None] + slots.astype(np.int64).view(np.uint64) * factor).ravel()
        near = away <= hashing.reach
        away, summed = away[near], summed[near]
        if most is not None and len(away) > most:
            return None
    return _bucket(table, summed[np.argsort(away, kind="stable")])


def fit(queries: np.ndarray, found: np.ndarray, of: np.ndarray, sample: np.ndarray, n: int, target: float) -> Hashing:
    """The hashing that takes least work for the share ``target`` of true neighbours.

    ``found[i]`` is a true neighbour of query ``of[i]``; ``sample`` stands for ``n`` vectors.
    """
    rng = np.random.default_rng(11)
    d = sample.shape[1]
    asked, best = pointed(queries), None
    near, some = lifted(found), lifted(sample)
    for tables in TABLES:
        for count in PROJECTIONS:
            lines, shifts = rng.normal(size=(tables, count, d + 1)), rng.random((tables, count))
            for width in WIDTHS:
                h = Hashing(lines, shifts * width, width, 0.0)
                q, p, s = places(h, asked), places(h, near), places(h, some)
                away = _gaps(q[of], np.floor(p / width), width).sum(2).min(1)
                h = h._replace(reach=float(np.quantile(away, target)) + 1e-9)
                slots, seen, counted = np.floor(s / width), 0.0, []
                for place in q[:: max(1, len(q) // 16)]:
                    seen += float((_gaps(place, slots, width).sum(2) <= h.reach).sum()) / len(some)
                    counted += [visits(h, place[t], t, MOST_VISITS) for t in range(tables)]
                if any(c is None for c in counted):
                    continue
                asks = len(counted) / tables
                work = n * seen / asks + VISIT * sum(map(len, counted)) / asks
                if best is None or work < best[0]:
                    best = work, h
    if best is None:  # slots so wide that few are within reach
        h = Hashing(rng.normal(size=(2, 2, d + 1)), 8 * rng.random((2, 2)), 8.0, 0.0)
        away = _gaps(places(h, asked)[of], np.floor(places(h, near) / h.width), h.width).sum(2).min(1)
        return h._replace(reach=float(np.quantile(away, target)) + 1e-9)
    return best[1]


def _top(k: int, queries: np.ndarray):
    """Compare every row with all ``queries``: rows (probe, node, score) of the best ``k`` of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, nodes = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            best = np.hstack([best, queries @ as_matrix(batch.column(1)).T])
            nodes = np.hstack([nodes, np.broadcast_to(batch.column(0).to_numpy(), (len(queries), batch.num_rows))])
            order = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, nodes = np.take_along_axis(best, order, 1), np.take_along_axis(nodes, order, 1)
        probe = np.repeat(np.arange(len(queries)), best.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(probe, pa.int32()), pa.array(nodes.ravel()), pa.array(best.ravel())], ["probe", "node", "score"])

    return run


def _homes(hashing: Hashing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = homes(hashing, lifted(as_matrix(batch.column(1))))
                node = np.repeat(batch.column(0).to_numpy(), cells.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(cells.ravel())], ["node", "cell"])

    return run


def _visits(hashing: Hashing):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, cells, held = [], [], 0
            for node, place in zip(batch.column(0).to_pylist(), places(hashing, pointed(as_matrix(batch.column(1))))):
                cells += [visits(hashing, place[t], t) for t in range(len(place))]
                nodes += [np.full(len(c), node) for c in cells[-len(place) :]]
                held += sum(map(len, cells[-len(place) :]))
                if held > _PENDING:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(cells))], ["node", "cell"])
                    nodes, cells, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(cells))], ["node", "cell"])

    return run


class _Members(NamedTuple):
    """The members of a region, by unit; ``low`` is the place of their smallest keys among all of the region."""

    unit: np.ndarray
    node: np.ndarray
    low: np.ndarray
    x: np.ndarray
    keys: pa.Array


def _best(k: int, q: np.ndarray, m: np.ndarray, asks: np.ndarray, held: _Members) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of candidates (query, member) the best ``k`` nodes of each query, with exact scores."""
    score = np.concatenate([(asks[q[a : a + 65536]] * held.x[m[a : a + 65536]]).sum(1) for a in range(0, len(q), 65536)] or [np.zeros(0)])
    order = np.lexsort((held.node[m], held.low[m], -score, q))
    q, m, score = q[order], m[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (held.node[m][1:] != held.node[m][:-1])
    q, m, score = q[new], m[new], score[new]
    good = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[good], m[good], score[good]


def _rank(k: int, asks: np.ndarray, of: np.ndarray, unit: np.ndarray, held: _Members) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` members of the units that queries (``of``, indices into ``asks``) visit."""
    order = np.argsort(unit, kind="stable")
    of, unit = of[order], unit[order]
    cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True]) if len(unit) else np.zeros(1, int)
    least = np.full(len(asks), -np.inf)
    # Products come in another order than the exact ones; what is that close is kept until those are taken.
    slack = 1e-12 * np.sqrt((asks * asks).sum(1)) * np.sqrt((held.x * held.x).sum(1).max(initial=0))
    q, m, pending = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        first, last = np.searchsorted(held.unit, unit[a]), np.searchsorted(held.unit, unit[a], "right")
        if first == last:
            continue
        mine = of[a:b]
        score = asks[mine] @ held.x[first:last].T
        if last - first > k:
            least[mine] = np.maximum(least[mine], np.partition(score, last - first - k, axis=1)[:, last - first - k])
        row, col = np.nonzero(~(score < (least[mine] - slack[mine])[:, None]))
        q.append(mine[row])
        m.append(first + col)
        pending += len(row)
        if pending > _PENDING:
            kept = _best(k, np.concatenate(q), np.concatenate(m), asks, held)
            q, m, pending = [kept[0]], [kept[1]], 0
    return _best(k, np.concatenate(q), np.concatenate(m), asks, held)


def _ranked(k: int):
    """Rows (asked, node, low, score); what comes in is sorted by region, members before queries."""

    def members(rows: list[pa.RecordBatch]) -> _Members:
        unit, node = (np.concatenate([r.column(i).to_numpy() for r in rows]) for i in (2, 4))
        keys = pa.chunked_array([r.column(5) for r in rows])
        low = pc.rank(keys, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.argsort(unit, kind="stable")
        x = np.concatenate([as_matrix(r.column(6)) for r in rows])[order]
        return _Members(unit[order], node[order], low[order], x, keys.combine_chunks().take(pa.array(order)))

    def answer(batch: pa.RecordBatch, held: _Members) -> pa.RecordBatch:
        lists = batch.column(3)
        sizes = np.diff(lists.offsets.to_numpy())
        of = np.repeat(np.arange(batch.num_rows), sizes)
        q, m, score = _rank(k, as_matrix(batch.column(6)), of, lists.flatten().to_numpy(), held)
        return pa.RecordBatch.from_arrays(
            [pa.array(batch.column(4).to_numpy()[q]), pa.array(held.node[m]), held.keys.take(pa.array(m)), pa.array(score)],
            ["asked", "node", "low", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, held, waiting = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            regions = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((regions[1:] != regions[:-1]) | (asks[1:] != asks[:-1])) + 1
            cuts = [0, *edge.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if region != regions[a]:
                    region, held, waiting = regions[a], None, []
                if not asks[a]:
                    waiting.append(batch.slice(a, b - a))
                    continue
                if held is None and waiting:
                    held, waiting = members(waiting), []
                for c in range(a, b, _CHUNK):
                    if held is not None:
                        yield answer(batch.slice(c, min(_CHUNK, b - c)), held)

    return run


def _meet(nodes: DataFrame, homes: DataFrame, visits: DataFrame, k: int, purpose: str) -> DataFrame:
    """The best ``k`` nodes of every query node that ``visits`` (node, cell), among ``homes`` (node, cell).

    Crowded cells are cut into units of members times queries; units are dealt to regions, and a query goes once
    to each region that it visits.
    """
    crowd = homes.groupBy("cell").agg(F.count("*").alias("members")).join(visits.groupBy("cell").agg(F.count("*").alias("asks")), "cell")
    crowd = crowd.select(
        "cell",
        "members",
        F.ceil(F.col("members") / MEMBERS).cast("int").alias("blocks"),
        F.ceil(F.col("asks") / QUERIES).cast("int").alias("parts"),
    )
    crowd = materialize(crowd, f"{purpose}-crowd")
    total = crowd.agg(F.sum(F.col("members") * F.col("parts"))).first()[0] or 0
    regions = max(1, -(-total // REGION))

    def unit(block: Column, part: Column) -> Column:
        return F.xxhash64("cell", block.cast("int"), part.cast("int"))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    block, part = F.pmod(F.xxhash64("node"), F.col("blocks")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    region = F.pmod(F.xxhash64("unit", F.lit(2)), F.lit(regions)).cast("int").alias("region")
    held = homes.join(crowd, "cell").withColumn("part", every("parts")).select("node", unit(block, F.col("part")).alias("unit"))
    asked = visits.join(crowd, "cell").withColumn("block", every("blocks")).select("node", unit(F.col("block"), part).alias("unit"))
    asked = asked.select("node", "unit", region).groupBy("node", "region").agg(F.collect_list("unit").alias("units"))
    vectors = nodes.select("node", "low", "v")
    as_member = held.join(vectors, "node").select(region, F.lit(False).alias("asks"), "unit", F.array().cast("array<long>").alias("units"), "node", "low", "v")
    as_query = asked.join(vectors, "node").select("region", F.lit(True).alias("asks"), F.lit(0).cast("long").alias("unit"), "units", "node", "low", "v")
    dealt = as_member.union(as_query).repartition("region").sortWithinPartitions("region", "asks")
    kind = nodes.schema["low"].dataType.simpleString()
    return map_arrow(dealt, _ranked(k), f"asked long, node long, low {kind}, score double")


def nearest(
    df: DataFrame,
    queries: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    k: int = 20,
    target: float = 0.95,
    probes: int = PROBES,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of the ``k`` rows found nearest to each query row.

    Queries are the rows for which ``queries`` (a column over ``df``) is true; candidates are all rows but the query's
    own. Nearness is the inner product in double precision; ties go to the smaller key. A query has all its
    candidates if these are fewer than ``k``, and never fewer than ``k`` otherwise: where the visited buckets
    hold too few, it is compared with all rows, in blocks. Repeated rows are candidates each, also for each other.

    Vectors that are NULL, empty or zero, or hold NULL or values that are not finite, take no part; vectors of different
    lengths are no candidates of each other (each length has an index and a run of its own). NULL keys come last among ties. Scores
    beyond the doubles are infinite. Other columns are left out; an empty table, or one without queries, gives no rows.

    The hashing is fitted with the true neighbours of at most ``probes`` queries and the buckets are sized with at
    most ``sample`` vectors; every vector is indexed.
    """
    whole = df.select(F.col(key).alias("key"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    usable = whole.where(finite_vectors("v")).withColumn("node", F.xxhash64("v")).withColumn("d", F.size("v"))
    rows = materialize(usable, "searched-vectors")
    sizes = sorted(r["d"] for r in rows.groupBy("d").agg(F.max("asks").alias("asks")).where("asks").collect())
    found = [_search(rows.where(F.col("d") == d), k, target, probes, sample) for d in sizes]
    kind = df.schema[key].dataType.simpleString()
    if not found:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score double")
    out = found[0]
    for other in found[1:]:
        out = out.union(other)
    return out.select("query_id", "rank", F.col("key").alias(key), "score")


def _search(rows: DataFrame, k: int, target: float, probes: int, sample: int) -> DataFrame:
    """``nearest`` over usable rows (key, v, asks, node) of one length."""
    by_key = Window.partitionBy("node").orderBy(F.col("key").asc_nulls_last())
    # No query needs more rows of one vector than this.
    lows = materialize(rows.select("node", "key", F.row_number().over(by_key).alias("place")).where(F.col("place") <= k + 1), "first-keys")
    nodes = rows.groupBy("node").agg(F.max("asks").alias("asks"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = materialize(nodes.join(lows.where("place = 1").select("node", F.col("key").alias("low")), "node"), "vectors")
    asking = nodes.where("asks").select("node", "v")
    size = nodes.agg(F.count("*").alias("n"), F.sum("copies").alias("rows")).first()

    tried = asking.orderBy("node").limit(probes).toArrow()
    ask = as_matrix(tried.column("v").combine_chunks())
    near = map_arrow(nodes.select("node", "v"), _top(k + 1, ask), "probe int, node long, score double")
    best = Window.partitionBy("probe").orderBy(F.desc("score"), "node")
    near = near.select("probe", "node", F.row_number().over(best).alias("place")).where(F.col("place") <= k + 1).join(nodes.select("node", "v"), "node")
    near = near.select("probe", "node", "v").toArrow()
    of, hit = near.column("probe").to_numpy(), near.column("node").to_numpy()
    other = hit != tried.column("node").to_numpy()[of]
    if not other.any():
        other[:] = True  # a single vector
    some = nodes.select("v", "node").orderBy("node").limit(sample).select("v").toArrow()
    truth = as_matrix(near.column("v").combine_chunks())
    hashing = fit(ask, truth[other], of[other], as_matrix(some.column("v").combine_chunks()), size["n"], target)

    home = materialize(map_arrow(nodes.select("node", "v"), _homes(hashing), "node long, cell long"), "homes")
    visit = materialize(map_arrow(asking, _visits(hashing), "node long, cell long"), "visits")
    found = materialize(_listed(_meet(nodes, home, visit, k + 1, "search"), lows, k), "found")
    # Too few in the visited buckets: these queries meet all vectors, in blocks.
    enough = found.where(F.size("near") >= min(k + 1, size["rows"])).select("node")
    short = materialize(asking.join(enough, "node", "left_anti").select("node", F.lit(0).cast("long").alias("cell")), "short-queries")
    if short.limit(1).count():
        everything = nodes.select("node", F.lit(0).cast("long").alias("cell"))
        rest = _listed(_meet(nodes, everything, short, k + 1, "rest"), lows, k)
        found = found.join(short, "node", "left_anti").union(materialize(rest, "found-rest"))

    # The query rows of one vector can be very many; its results go to each share of them.
    salt = F.pmod(F.xxhash64("key"), F.lit(_DEALT)).cast("int")
    mine = rows.where("asks").select("key", "node", salt.alias("salt"))
    spread = found.select(F.col("node").alias("of"), "near", F.explode(F.sequence(F.lit(0), F.lit(_DEALT - 1))).alias("part"))
    told = mine.join(spread, (F.col("node") == F.col("of")) & (F.col("salt") == F.col("part")))
    own = F.array_position(F.transform("near", lambda e: (e["node"] == F.col("node")) & e["key"].eqNullSafe(F.col("key"))), True)
    others = F.when(own > 0, F.concat(F.slice("near", F.lit(1), (own - 1).cast("int")), F.slice("near", (own + 1).cast("int"), F.lit(k)))).otherwise(F.slice("near", 1, k))
    listed = told.select(F.col("key").alias("query_id"), F.posexplode(others).alias("rank", "hit"))
    return listed.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.key").alias("key"), F.col("hit.score").alias("score"))


def _listed(met: DataFrame, lows: DataFrame, k: int) -> DataFrame:
    """``node`` and ``near``, the ``k + 1`` first rows (node, key, score), of each query node."""
    each = met.groupBy("asked", "node", "low").agg(F.max("score").alias("score"))
    by_node = Window.partitionBy("asked").orderBy(F.desc("score"), F.col("low").asc_nulls_last())
    each = each.withColumn("place", F.row_number().over(by_node)).where(F.col("place") <= k + 1).drop("place")
    rows = each.join(lows.select("node", "key"), "node")
    by_row = Window.partitionBy("asked").orderBy(F.desc("score"), F.col("key").asc_nulls_last(), "node")
    rows = rows.withColumn("place", F.row_number().over(by_row)).where(F.col("place") <= k + 1)
    near = F.sort_array(F.collect_list(F.struct("place", "node", "key", "score")))
    return rows.groupBy(F.col("asked").alias("node")).agg(near.alias("near"))
