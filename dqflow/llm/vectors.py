"""Vectors as whole numbers of 1/1024."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.llm.frames import col

#: Steps in a unit of a component.
STEPS = 1024
#: A vector takes part if the squares of its steps sum to less: then inner products fit a long.
MOST_SQUARE = float(1 << 62)


def dimensions(df: DataFrame, vector_column: str) -> int:
    """Length of the longest vector, at least 1."""
    return max(1, df.agg(F.max(F.size(col(vector_column)))).first()[0] or 0)


def steps(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``vectors`` (lists of doubles) take part, and ``floor(1024 * x)`` of those, a row each.

    A vector that is null, holds a null or non-finite component or is longer than ``MOST_SQUARE``
    allows takes no part.  A shorter vector is as if filled with zeros.
    """
    sizes = np.asarray(vectors.value_lengths().fill_null(0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        every = np.zeros((len(vectors), dims))
        row = np.repeat(np.arange(len(vectors)), sizes)
        first = np.cumsum(sizes) - sizes
        every[row, np.arange(len(flat)) - first[row]] = np.floor(flat * STEPS)
        taken = (np.square(every).sum(axis=1) < MOST_SQUARE) & np.asarray(vectors.is_valid())
    return np.flatnonzero(taken), every[taken].astype(np.int64)
