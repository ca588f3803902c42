"""What the two vector operators share: which vectors take part, and arrays out of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sound(vector: Column) -> Column:
    """True for vectors that are not null, hold no null, NaN or infinite component and are not all zero."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~wrong & F.exists(vector, lambda x: x != 0), F.lit(False))


def usual_length(vectors: DataFrame, vector: str) -> int:
    """The commonest vector length, the smaller one of two; 0 in an empty table."""
    row = vectors.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return row[0] if row else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
