"""Vector columns: which rows are usable, and their batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and every component is a finite number; never null."""
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def widest(column: pa.Array | pa.ChunkedArray) -> int:
    """The length of the longest vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, dtype=np.float64) -> np.ndarray:
    """One row per vector; a shorter vector ends in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(dtype)
    x = np.zeros((len(lengths), width), dtype)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x[np.repeat(np.arange(len(lengths)), lengths), place] = flat
    return x
