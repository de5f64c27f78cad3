"""Vectors of whole numbers, for operators whose arithmetic has to be exact."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Components from here on could take a sum of 64 squares or products beyond 63 bits.
LIMIT = 1 << 27


def finite(vector: str) -> Column:
    """The vector is there and none of its components is null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def whole_numbers(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """``rows`` with ``ints`` = floor(scale * x) per component, x in double precision.

    Rows whose vector is null, holds a null or a non-finite component, or one that ``LIMIT`` shuts
    out, are left out.
    """
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) * scale < LIMIT - 1)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("int"))
    return rows.filter(finite(vector)).filter(small).withColumn("ints", whole)


def packed(column) -> np.ndarray:
    """Equally long int32 vectors of a column of lists or of bytes, a row each."""
    first = column.iloc[0]
    if isinstance(first, (bytes, bytearray)):
        return np.frombuffer(b"".join(column), np.int32).reshape(len(column), -1)
    return np.stack([np.asarray(v, np.int32) for v in column])
