"""Vector columns as whole numbers, and vector batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column | str) -> Column:
    """Whether a vector is there and all its components are; false, never null."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def whole(vector: Column | str, scale: int) -> Column:
    """floor(scale * x) of every component, x as double; what a long can't hold is the end of its range."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a batch as matrices of equal width: row numbers and components. Lists hold no nulls."""
    vectors = batch.column(column)
    widths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(widths)[:-1])) if len(widths) else widths
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if len(rows) == len(widths):
            yield rows, flat.reshape(len(rows), width)
        else:
            yield rows, flat[starts[rows][:, None] + np.arange(width)]
