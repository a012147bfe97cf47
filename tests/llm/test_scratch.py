"""Intermediate tables of the operators go with the block they are made in."""

from pathlib import Path

import pytest
from llm_tables import SMALL, docs_of  # noqa: F401

import __spark_entry__ as contract
from tidemark.llm.line_dedup import dedup_lines
from tidemark.plans.workspace import scratch


@pytest.mark.parametrize("name", ["op5_simhash", "op6_line_dedup", "op9_mix_sources", "op11_conversation_repair", "op12_nearest"])
def test_nothing_is_left_below_the_checkpoint_folder(spark, name):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir()) if root.exists() else set()
    with scratch(spark):
        rows = contract.queries()[name](spark, SMALL).collect()
    assert rows and set(root.iterdir()) == before


def test_text_keys_of_lines_are_refused(spark, docs_of):  # noqa: F811
    with pytest.raises(TypeError, match="whole numbers"):
        dedup_lines(docs_of([(1, "a")]).selectExpr("'k' AS doc_id", "text"))
