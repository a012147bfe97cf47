"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, conversation_repair, html_paths, license_scan, line_dedup, line_quality, mixing, multi_index, p_stable, periodic_runs, secret_scan, simhash, suffix_tree
from tidemark.llm.common import table

#: Rank file and pattern of the tokenizer; a path that every node has.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return suffix_tree.score(table(spark, sf_dir, "documents"), held_out)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN, with_decoded=True)
    return encoded.select("doc_id", *bpe_digests())


def bpe_digests() -> list[Column]:
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return [
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.judge(docs, field)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.size("same_lines").alias("n_same_lines"),
        F.size("near_lines").alias("n_near_lines"),
        F.array_join(F.sort_array(F.concat("same_lines", "near_lines")).cast("array<string>"), ",").alias("lines_gone"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_paths.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.RULES[:3]]

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults by a hash of their place; rows that are dropped have ``there`` false."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(fault == 4, "user").otherwise(space("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("there"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = conversation_repair.repair(damaged(table(spark, sf_dir, "conversations")), there=F.col("there"))
    return conversation_repair.join_pieces(pieces)


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p_stable.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def planted_runs(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the rows, by the hash of the key, repeated from some word on; other texts stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + F.pmod(i - a, p)))), " ")

    # One element, so that the words are found once for all uses.
    whole = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(F.lit(""))), F.lit(0))
    return F.when(h % 10 == 0, whole).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", planted_runs(F.col("doc_id"), F.col("text")).alias("text")))

    def stronger(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    # Runs come by start, then period, so the first of the strongest is the one asked for.
    first = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), stronger)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("best", first).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_suffix_tree,
        op3_byte_bpe,
        op4_line_quality,
        op5_simhash,
        op6_line_dedup,
        op7_multi_index,
        op8_html_paths,
        op9_mix_sources,
        op10_secret_scan,
        op11_conversation_repair,
        op12_nearest,
        op13_periodic_runs,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LICENSES = f"""
WITH t(license, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in license_scan.TEMPLATES.items())}),
tw AS (SELECT license, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM t),
ts AS (SELECT DISTINCT license, array_to_string(w[i + 1:i + 5], ' ') AS s FROM tw, unnest(range(0, len(w) - 4)) AS u(i)),
tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
dw AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
    FROM documents
),
ds AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM dw, unnest(range(0, len(w) - 4)) AS u(i)),
m AS (
    SELECT doc_id, license, count(DISTINCT s) AS n_found, min(i) AS first_word
    FROM ds JOIN ts USING (s) GROUP BY doc_id, license
)
SELECT doc_id, license, CAST(n_found AS DOUBLE) / n AS containment, CAST(first_word AS BIGINT) AS first_word
FROM m JOIN tn USING (license) WHERE CAST(n_found AS DOUBLE) / n >= 0.8
"""

_MIX = """
WITH d AS (
    SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) AS hash
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap,
        (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(source_size * 2.0::DOUBLE) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s WINDOW r AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST)
), t AS (
    SELECT source, source_size, coalesce(least(cap, weight * max(level) FILTER (cap >= level * weight) OVER ()), cap) AS target FROM l
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), c AS (
    SELECT d.*, source_size, target, whole, target - whole * source_size AS budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY hash RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(size) OVER (PARTITION BY d.source, hash) AS own,
        count(*) OVER (PARTITION BY d.source, hash) AS alike,
        row_number() OVER (PARTITION BY d.source, hash) AS nth
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), k AS (
    SELECT *, (budget - (upto - own)) * alike AS scaled FROM c
)
SELECT doc_id, source, size, source_size, target,
    CAST(size * (whole + CASE WHEN budget > 0 AND (upto <= budget
        OR nth <= floor(scaled / own) + CASE WHEN 2 * (scaled - floor(scaled / own) * own) > own THEN 1 ELSE 0 END) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k
"""

SQL = {"op1_license_scan": _LICENSES, "op9_mix_sources": _MIX}
