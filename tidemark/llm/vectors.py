"""Vectors as Arrow lists and as Spark arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def finite_vectors(column: str) -> Column:
    """Whether an array of numbers has some, all of them finite and not all zero."""
    limit = F.lit(float("inf"))
    plain = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < limit))
    return F.coalesce(plain & F.exists(column, lambda c: c != 0), F.lit(False))
