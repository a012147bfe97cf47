"""The driver contract without the corpus operators."""

import subprocess
import sys

from conftest import ROOT, SMALL

WITHOUT = """
import sys
sys.modules["corpus_pipeline"] = sys.modules["tidemark.llm"] = None
import __spark_entry__ as contract
names = contract.queries().keys()
assert names == contract.oracle_sql().keys(), names ^ contract.oracle_sql().keys()
assert "pipeline" not in names and not any(n.startswith("op1") for n in names)
"""


def test_the_other_queries_stand_without_them():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_them():
    for file in (*ROOT.glob("tidemark/**/*.py"), *ROOT.glob("catalog/*.py"), ROOT / "bench.py"):
        if "llm" not in file.parts:
            assert "tidemark.llm" not in file.read_text(), file


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", "2").getOrCreate()
)
rows = contract.queries()["offset_roundtrip"](spark, sys.argv[3]).collect()
assert len(rows) == 8 and all(r.n_lost == 0 and r.n_values > 0 for r in rows), rows
"""


def test_tasks_find_the_package_wherever_the_driver_was_started(tmp_path):
    """Rows are collected: a count would prune the Python step away."""
    at = [str(ROOT), str(tmp_path / "checkpoints"), SMALL]
    done = subprocess.run([sys.executable, "-c", ELSEWHERE, *at], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
