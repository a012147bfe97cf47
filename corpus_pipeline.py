"""A corpus pipeline: quality rules, line dedup, near-dedup, source mix and token ids, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, line_dedup, line_quality, mixing, simhash
from tidemark.llm.common import table, write_table
from tidemark.llm.queries import PATTERN, RANKS, bpe_digests
from tidemark.plans.workspace import scratch, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field and the base rules keep; the field learns from the labels of ``sf_dir``."""
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    judged = line_quality.judge(docs, field, keep=tuple(docs.columns), prefix="_quality_")
    return judged.where("_quality_kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that earlier ones make redundant; a document goes if no word is left."""
    return line_dedup.dedup_lines(docs).where(line_dedup.has_words("text")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; equal rows stay once."""
    return simhash.keep_one(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digest and that of the decoded bytes."""
    encoded = byte_bpe.encode(docs, RANKS, PATTERN, keep=("doc_id", "lang", "source"), with_decoded=True)
    return encoded.select("doc_id", "lang", "source", *bpe_digests(), "token_ids")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("source mix", mix),
    ("byte-level bpe", tokens),
]

#: SQL cannot express the field, the line edits and the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-"))
        with scratch(spark):  # what a stage writes on its way goes once its result is there
            docs = write_table(stage(spark, docs, sf_dir), path)
    return STAGES[-1][1](spark, docs, sf_dir)
