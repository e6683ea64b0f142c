"""Vector tables: which rows take part, and their vectors as integer matrices within a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """The named columns and vec (array<double>) of rows whose embedding is neither null nor holds null or non-finite components; and its dimension.

    Vectors can only be held against each other in one dimension: it is the commonest (the larger of equally common ones).
    Empty vectors and those of other dimensions are left out. Without any row the dimension is 0.
    """
    rows = df.select(*columns, F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(fine)
    top = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = top["dim"] if top else 0
    return rows.where(F.size("vec") == dim), dim


def scaled(column: pa.Array, dim: int, factor: int, most: int) -> np.ndarray:
    """floor(factor * component) of a batch's vectors, as integers; an error where one exceeds `most` in size."""
    x = np.floor(np.asarray(column.flatten(), np.float64).reshape(-1, dim) * factor)
    if len(x) and np.abs(x).max() > most:
        raise ValueError(f"a component times {factor} exceeds {most}: sums wouldn't be exact")
    return x.astype(np.int64)
