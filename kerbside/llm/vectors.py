"""Vectors that can be compared by direction."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import numpy as np


def is_direction(vector: Column) -> Column:
    """Whether a vector has components that are all finite and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    return F.coalesce(~bad & ~zero, F.lit(False))


def lengths_of(df: DataFrame, vector_col: str) -> list[int]:
    """The different lengths of the vectors. A length is a row, so few reach the driver."""
    return sorted(row["d"] for row in df.select(F.size(vector_col).alias("d")).distinct().collect())


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square leaves range."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def cosines(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Cosine of each row with the row beside it: the same for the same two vectors, always."""
    first, second = first.astype(np.float64), second.astype(np.float64)
    norms = np.sqrt((first**2).sum(axis=1)) * np.sqrt((second**2).sum(axis=1))
    with np.errstate(all="ignore"):
        plain = (first * second).sum(axis=1) / norms
    odd = ~np.isfinite(plain) | (norms < 1e-150) | (norms > 1e150)
    if odd.any():
        plain[odd] = (unit(first[odd]) * unit(second[odd])).sum(axis=1)
    return plain
