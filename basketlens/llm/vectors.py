"""Helpers on embedding columns."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not NULL, not zero, and free of NULL and non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length, ties to the longer; vectors of another length can't be compared with the rest."""
    top = df.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column, or a pandas column of lists, as rows of doubles."""
    if hasattr(column, "flatten"):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, dim))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products, each summed in the order of components: equal vectors get equal products anywhere."""
    out = np.zeros((len(x), len(y)))
    for d in range(x.shape[1]):
        out += x[:, d, None] * y[None, :, d]
    return out
