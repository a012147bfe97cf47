"""Where logs, checkpoints and intermediate tables go: the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    The setting is mandatory on a cluster. A local session without it gets a
    temporary folder, and the setting with it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"Set '{CHECKPOINT_DIR}' to a folder all executors share.")
        root = _local_root()
    folder = f"{root.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return folder


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that are named within the block are deleted at its end.

    Write or collect a result before that: until then it may read intermediate tables. Blocks may be nested; what is
    to outlive one is named before it begins.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.pop()
        for folder in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_LOCAL_ROOT: list[str] = []


def _local_root() -> str:
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL_ROOT[0]
