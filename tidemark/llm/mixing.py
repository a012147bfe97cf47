"""Mixing sources to target weights by hash-threshold histograms, without sorting.

Every row has a fixed 48-bit hash. A source gives whole copies of all its rows as often as its target
allows, and one copy more of the rows whose hash is below a threshold. Thresholds come from histograms:
sizes are summed by source and hash bucket, the bucket in which the budget ends is found, and only its
rows are counted again in finer buckets, until the buckets are single hashes. Rows that are equal in key and text share
a hash; if the budget ends among them, they are split the same way by a second hash, so any number of them can go in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, materialize

#: 12 bits of the hash are refined at a time.
HASH_BITS, STEP_BITS = 48, 12
#: Copies of one row that are made in one place.
PORTION = 1000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(key: str, text: str) -> Column:
    """48 bits from key and text, so that neither repeated nor missing keys share a threshold's bucket."""
    own = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(own), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """``target`` for each ``source`` of ``sizes(source, source_size)``.

    Sources in order of code point, NULL last, take ``weights`` in turn and share ``share`` times the
    total. A target stops at ``most`` times its source's size; what that leaves over is shared again by
    weight until no target is above. One row per source goes through one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
    full = weighted.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = full.withColumn("level", level)
    # The first source, by room, that does not fill up sets the level of all that follow.
    last = F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(everything)
    return levels.withColumn("target", F.coalesce(F.least("cap", last * F.col("weight")), F.col("cap"))).select("source", "source_size", "target")


def _tie(row: Column) -> Column:
    return F.conv(F.substring(F.md5(row), 1, HASH_BITS // 4), 16, 10).cast("long")


def _sized(df: DataFrame, text: str, key: str, source: str, tie: Column) -> DataFrame:
    columns = F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"), row_hash(key, text).alias("hash")
    return materialize(df.select(*columns, tie.alias("tie")), "sizes")


def _refined(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Where budgets end: for each of ``cuts(source, budget)`` the ``hash`` of ``rows(source, size, hash)`` at which the
    sum of sizes by hash passes the budget, the ``budget`` left there, and its size ``n`` and rows ``c``."""
    cuts = cuts.select("source", F.lit(0).cast("long").alias("prefix"), "budget")
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        buckets = rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("n"), F.count("*").alias("c"))
        named = cuts.select(F.col("source").alias("s"), "prefix", "budget")
        inside = buckets.join(
            named, buckets["source"].eqNullSafe(F.col("s")) & (F.shiftright("bucket", STEP_BITS) == F.col("prefix"))
        ).drop("s")
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        told = inside.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        ends = told.where("before <= budget AND budget < before + n")
        cuts = materialize(ends.select("source", F.col("bucket").alias("prefix"), (F.col("budget") - F.col("before")).alias("budget"), "n", "c"), "cuts")
        near = cuts.select(F.col("source").alias("s"), "prefix")
        rows = rows.join(near, rows["source"].eqNullSafe(F.col("s")) & (F.shiftright("hash", shift) == F.col("prefix")), "left_semi")
    return cuts.withColumnRenamed("prefix", "hash")


def thresholds(rows: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """For each ``source`` of ``rows(source, size, hash, tie)``: ``source_size``, ``target``, ``whole``, ``limit``,
    ``tie_limit`` and ``rest``.

    The mix takes ``whole`` copies of every row and one more of those with a hash below ``limit``, of those at it with a
    tie below ``tie_limit``, and of ``rest`` rows with that very tie.
    """
    summed = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(summed, list(weights), share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(ratio).cast("int")).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan, "targets")

    cuts = _refined(rows.where("size > 0").select("source", "size", "hash"), plan.select("source", "budget"))
    # Of the rows at the threshold as many go in as come closest; no cut: the budget takes no row, or all.
    scaled = F.col("budget") * F.col("c")
    fewer = F.floor(scaled / F.col("n"))
    wanted = fewer + F.when(2 * (scaled - fewer * F.col("n")) > F.col("n"), 1).otherwise(0)
    cuts = cuts.select("source", F.col("hash").alias("limit"), "c", wanted.alias("wanted"))
    cuts = cuts.withColumn("limit", F.col("limit") + (F.col("wanted") == F.col("c")).cast("int"))
    ties = None
    split = cuts.where("wanted > 0 AND wanted < c")
    if split.limit(1).count():
        named = split.select(F.col("source").alias("s"), "limit")
        at = rows.join(named, rows["source"].eqNullSafe(F.col("s")) & (rows["hash"] == F.col("limit")), "left_semi")
        ties = _refined(at.where("size > 0").select("source", F.lit(1).cast("long").alias("size"), F.col("tie").alias("hash")), split.select("source", F.col("wanted").cast("double").alias("budget")))
        ties = ties.select(F.col("source").alias("t"), F.col("hash").alias("tie_limit"), F.col("budget").cast("long").alias("rest"))
    plan = plan.join(cuts.select(F.col("source").alias("s"), "limit"), plan["source"].eqNullSafe(F.col("s")), "left")
    if ties is None:
        plan = plan.withColumns({"tie_limit": F.lit(None).cast("long"), "rest": F.lit(None).cast("long")})
    else:
        plan = plan.join(ties, plan["source"].eqNullSafe(F.col("t")), "left")
    everything = F.when(F.col("budget") > 0, F.lit(1 << HASH_BITS)).otherwise(0)
    nothing = F.lit(0).cast("long")
    return plan.select(
        "source", "source_size", "target", "whole", F.coalesce("limit", everything).alias("limit"),
        F.coalesce("tie_limit", nothing).alias("tie_limit"), F.coalesce("rest", nothing).alias("rest"),
    )


def _one_more(hash_: Column, tie: Column, limit: Column, tie_limit: Column) -> Column:
    return F.when((hash_ < limit) | ((hash_ == limit) & (tie < tie_limit)), 1).otherwise(0)


def mix_sources(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``key``, ``hash``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` of every row.

    ``size`` is the number of words of the whole text (NULL: 0). ``copies`` is a whole number up to
    ``most``; the sum of size times copies of a source comes as close to its target as the rows around
    the threshold allow. Of rows that are equal in key and text as many are taken once more as come closest; runs over
    the same rows agree but for which of such rows these are. Other columns are left out; an empty table gives no rows.
    """
    rows = _sized(df, text, key, source, _tie(F.monotonically_increasing_id().cast("string")))
    plan = thresholds(rows, weights, share, most).withColumnRenamed("source", "s")
    mixed = rows.join(plan, rows["source"].eqNullSafe(F.col("s")))
    copies = F.col("whole") + _one_more(F.col("hash"), F.col("tie"), F.col("limit"), F.col("tie_limit"))
    return mixed.select(F.col("key").alias(key), "hash", F.col("source").alias(source), "size", "source_size", "target", copies.alias("copies"))


def take(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """All columns of every row, as many times as the mix takes it. Rows equal in all columns stand for each other."""
    row = _tie(F.to_json(F.struct(*(df[c] for c in df.columns))))
    # Written, so that its size is known: a row for each source need not make the texts move.
    plan = materialize(thresholds(_sized(df, text, key, source, row), weights, share, most), "thresholds")
    plan = plan.select(F.col("source").alias("_source"), *(F.col(c).alias(f"_{c}") for c in ("whole", "limit", "tie_limit", "rest")))
    hash_ = row_hash(key, text)
    mixed = df.join(plan, df[source].eqNullSafe(F.col("_source")))
    if not plan.where("_tie_limit > 0 OR _rest > 0").limit(1).count():
        copies = F.col("_whole") + F.when(hash_ < F.col("_limit"), 1).otherwise(0)
        return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*(df[c] for c in df.columns))
    copies = F.col("_whole") + _one_more(hash_, row, F.col("_limit"), F.col("_tie_limit"))
    taken = mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*(df[c] for c in df.columns))
    # Some of many equal rows: one stands for them, repeated in portions that are dealt out.
    whole = F.struct(*(df[c] for c in df.columns)).alias("_row")
    last = mixed.where((hash_ == F.col("_limit")) & (row == F.col("_tie_limit")) & (F.col("_rest") > 0)).select(whole, "_source", "_rest")
    one = last.groupBy("_source", "_rest").agg(F.any_value("_row").alias("_row"))
    portions = one.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rest") - 1, F.lit(PORTION).cast("long")))).repartition("_from")
    size = F.least(F.col("_rest") - F.col("_from"), F.lit(PORTION)).cast("int")
    more = portions.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), size))).select(*(F.col("_row")[c].alias(c) for c in df.columns))
    return taken.union(more)
