"""Row-local expressions over numeric arrays and ML vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_index(values: Column) -> Column:
    """0-based index of the largest element; the first wins ties."""
    return F.array_position(values, F.array_max(values)) - 1


def scale(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda x: x * factor)


def normalise_sum(values: Column) -> Column:
    """Divide by the sum; an all-zero array becomes uniform."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(
        total > 0, F.transform(values, lambda x: x / total)
    ).otherwise(F.transform(values, lambda x: F.lit(1.0) / F.size(values)))


def vector_cells(vector: Column) -> Column:
    """Array of (idx, value) with the stored entries of a sparse or dense vector."""
    raw = F.unwrap_udt(vector)
    sparse = F.zip_with(
        raw["indices"], raw["values"], lambda i, x: F.struct(i.alias("idx"), x.alias("value"))
    )
    dense = F.transform(raw["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    return F.when(raw["type"] == 0, sparse).otherwise(dense)


def masked_mean_pool(token_vectors: Column, mask: Column, eps: float = 1e-9) -> Column:
    """Mean of the token vectors whose mask is set; the count is floored at ``eps``."""
    weighted = F.zip_with(
        token_vectors, mask, lambda v, m: F.transform(v, lambda x: x.cast("double") * m)
    )
    zero = F.transform(F.get(token_vectors, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(weighted, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    count = F.aggregate(mask, F.lit(0.0), lambda acc, m: acc + m)
    return F.transform(total, lambda x: x / F.greatest(count, F.lit(eps)))


def align_to_labels(proba: Column, classes: list, labels: list) -> Column:
    """Reorder class probabilities into the label space; absent classes get 0."""
    where = {c: i for i, c in enumerate(classes)}
    return F.array(
        *[proba[where[x]].cast("double") if x in where else F.lit(0.0) for x in labels]
    )


# Cells of a dense matrix that goes to every worker, and of those gathered at once (8 bytes each).
MATRIX_CELLS, GATHER_CELLS = 16 << 20, 4 << 20


def project_rows(matrix: np.ndarray, finish=None):
    """Pandas UDF: (indices, values) of sparse rows times a dense matrix.

    The matrix, at most `MATRIX_CELLS`, is shipped once per worker with the function. Rows are
    taken in groups whose gathered cells stay under `GATHER_CELLS`.
    """
    width = matrix.shape[1]
    if matrix.size > MATRIX_CELLS:
        raise ValueError(f"a matrix of {matrix.shape} is too large to be sent to every worker: reduce the features or the components")

    @F.pandas_udf("array<double>")
    def project(indices: pd.Series, values: pd.Series) -> pd.Series:
        sizes = np.array([len(i) for i in indices], dtype=np.int64)
        out = np.zeros((len(sizes), width))
        filled = np.flatnonzero(sizes)
        group = np.cumsum(sizes[filled]) * width // GATHER_CELLS
        for g in np.unique(group):
            rows = filled[group == g]
            idx = np.concatenate([indices.iloc[r] for r in rows]).astype(np.int64)
            val = np.concatenate([values.iloc[r] for r in rows])
            starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
            out[rows] = np.add.reduceat(matrix[idx] * val[:, None], starts, axis=0)
        if finish is not None:
            out = finish(out)
        return pd.Series(list(out))

    return project


__all__ = [
    "align_to_labels",
    "argmax_index",
    "array_to_vector",
    "masked_mean_pool",
    "normalise_sum",
    "project_rows",
    "scale",
    "vector_cells",
    "vector_to_array",
]
