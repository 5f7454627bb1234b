"""Vector columns read as they are stored: a sparse vector of thousands of
one-hot slots costs its few entries, not an array of its length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stored(features: str) -> tuple[Column, Column]:
    """(indices, values): indices are NULL where the vector is dense."""
    v = F.unwrap_udt(F.col(features))
    return v["indices"], v["values"]


def length(features: str) -> Column:
    v = F.unwrap_udt(F.col(features))
    return F.coalesce(v["size"], F.size(v["values"]))


def slot(features: str, s: int) -> Column:
    """The vector's value at one place; what a sparse vector leaves out is 0."""
    indices, values = stored(features)
    at = F.when(indices.isNull(), F.lit(s)).otherwise((F.array_position(indices, s) - 1).cast("int"))
    return F.when(values.isNotNull(), F.coalesce(F.get(values, at), F.lit(0.0)))


def entries(indices: pd.Series, values: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, value) of every stored entry of a batch."""
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    index = [np.arange(n) if i is None else np.asarray(i) for i, n in zip(indices, sizes)]
    if not len(row):
        return row, row, row.astype(np.float64)
    return row, np.concatenate(index).astype(np.int64), np.concatenate([np.asarray(v, dtype=np.float64) for v in values])
