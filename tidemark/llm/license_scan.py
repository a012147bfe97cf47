"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies.

Everything on the data is DataFrame functions on one row at a time: no shuffle and no Python. Texts are cut
into windows of four shingles that overlap by three, templates into pieces of four shingles side by side
(single shingles for templates of fewer). Each of ``BANDS`` bands is one MinHash of a window. A window that
holds a piece of a template whole has a Jaccard similarity of 1 with it and collides in every band; one that
lacks a shingle at its edge has 3/5 and is missed with a probability of 0.4 ** BANDS. A text that holds at
least 0.8 of the shingles of a template holds a piece whole, as there are more pieces (a quarter of the
shingles) than shingles that may lack.
"""

from __future__ import annotations

import random
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.license_texts import TEMPLATES

SHINGLE, LEAST, BANDS = 5, 0.8, 2
#: Shingles of a piece, and of a window.
PIECE = 4
_NOT_A_WORD = r"[^\p{L}\p{N}]+"
#: MinHash permutes 64-bit hashes by exclusive or with these.
_SEEDS = [random.Random(11 + i).getrandbits(64) - (1 << 63) for i in range(BANDS)]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_A_WORD), "")


def shingles(w: Column) -> Column:
    """The hash of each run of five words."""

    def from_here(first: Column, i: Column) -> Column:
        return F.xxhash64(first, *(F.get(w, i + k) for k in range(1, SHINGLE)))

    return F.slice(F.transform(w, from_here), F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0)))


def _permuted(values: Column, seed: int) -> Column:
    return F.transform(values, lambda x: x.bitwiseXOR(F.lit(seed)))


def _with_next(values: Column, step: int) -> Column:
    """The lesser of each value and that ``step`` places on, where there is one."""
    later = F.slice(values, step + 1, F.greatest(F.size(values), F.lit(1)))
    return F.zip_with(values, later, lambda a, b: F.least(a, b))


def _computed(df: DataFrame, keep: list[str], **column: Column) -> DataFrame:
    """``df`` with one more column, computed once for each row.

    A plain projection would be copied into every expression and filter that uses it; the optimizer moves
    none across the (single) element of an exploded array.
    """
    ((name, value),) = column.items()
    return df.select(*keep, F.explode(F.array(value)).alias(name))


class Template(NamedTuple):
    license: str
    shingles: list[int]
    #: The MinHash of every piece, by band; of a template of fewer shingles than a piece has, of each shingle.
    keys: list[list[int]]

    @property
    def short(self) -> bool:
        return len(self.shingles) < PIECE


def compile_templates(spark: SparkSession, templates: dict[str, str]) -> list[Template]:
    """Hash the templates; this is as small as they are. Templates need five words at least."""
    each = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in templates.items()]
    rows = spark.range(1).select(F.explode(F.array(*each)).alias("t")).select("t.license", shingles(words(F.col("t.text"))).alias("s"))
    out = []
    for name, hashes in rows.collect():
        if not hashes:
            raise ValueError(f"Template '{name}' has fewer than {SHINGLE} words.")
        size = PIECE if len(set(hashes)) >= PIECE else 1
        starts = sorted({*range(0, len(hashes) - size + 1, size), len(hashes) - size})
        keys = [[min(h ^ seed for h in hashes[a : a + size]) for a in starts] for seed in _SEEDS]
        out.append(Template(name, sorted(set(hashes)), keys))
    return out


def _longs(values) -> Column:
    values = sorted(set(values))
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<bigint>")


def scan_licenses(df: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", key: str = "doc_id", least: float = LEAST) -> DataFrame:
    """``key``, ``license``, ``containment`` and ``first_word`` for every template that a row's text holds.

    Words are runs of letters and digits in lower case. A template is held if at least ``least`` of its
    different runs of five words occur in the text; ``first_word`` is the place of the first that does,
    from 0. NULL, empty and shorter texts hold none; other columns are left out; equal rows give equal
    rows, an empty table or no templates give no rows. Templates travel as literals of the plan: a set of
    some hundred texts.
    """
    compiled = compile_templates(df.sparkSession, templates) if templates else []
    if not compiled:
        return df.limit(0).select(key, F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word"))

    def wanted(short: bool, band: int) -> Column:
        return _longs(k for t in compiled if t.short == short for k in t.keys[band])

    rows = _computed(df.select(F.col(key), F.col(text).alias("_text")), [key], w=words(F.col("_text")))
    rows = _computed(rows, [key], s=shingles(F.col("w")))
    permuted = F.struct(*(_permuted(F.col("s"), seed).alias(f"b{i}") for i, seed in enumerate(_SEEDS)))
    rows = _computed(rows, [key, "s"], one=permuted)
    rows = _computed(rows, [key, "s", "one"], two=F.struct(*(_with_next(F.col(f"one.b{i}"), 1).alias(f"b{i}") for i in range(BANDS))))
    hits = [F.array_intersect(_with_next(F.col(f"two.b{i}"), 2), wanted(False, i)) for i in range(BANDS)]
    hits.append(F.array_intersect(F.col("one.b0"), wanted(True, 0)))
    found = _computed(rows, [key, "s"], hits=F.flatten(F.array(*hits))).where(F.size("hits") > 0)

    known = F.array(
        *(
            F.struct(
                F.lit(t.license).alias("license"),
                _longs(t.shingles).alias("shingles"),
                _longs(k for band in t.keys for k in band).alias("keys"),
            )
            for t in compiled
        )
    )
    candidates = found.select(key, "s", F.explode(F.filter(known, lambda t: F.arrays_overlap(t["keys"], F.col("hits")))).alias("t"))
    held = _computed(candidates, [key, "s", "t"], both=F.array_intersect("s", F.col("t.shingles")))
    told = held.withColumn("containment", F.size("both") / F.size("t.shingles")).where(F.col("containment") >= least)
    # array_intersect keeps the order of the text, so its first element is the first shingle found.
    return told.select(key, "t.license", "containment", (F.array_position("s", F.col("both")[0]) - 1).alias("first_word"))
