"""What the two vector operators share: valid vectors and their packed form."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, without null or non-finite components, not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & ok & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def matrix(vectors: list[np.ndarray] | list[list[float]]) -> np.ndarray:
    """Rows of equal length in double precision."""
    return np.array(vectors, np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that nothing overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))
