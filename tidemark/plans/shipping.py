"""The package on the executors, for tasks that run its Python code."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the code of this package to the executors, once per application.

    The archive is made where the driver runs; Spark's file server passes it on. A package that came
    as an archive itself (``--py-files``) is there already.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp()) / "tidemark-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` by code of this package, wherever the driver was started."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
