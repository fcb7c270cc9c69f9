"""Vectors of a list column as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def longest(df: DataFrame, vector_col: str) -> int:
    """The most components a vector has; 0 without any vector."""
    return max(0, df.agg(F.max(F.size(vector_col))).first()[0] or 0)


def matrix(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector (not null, every component a finite number), and all rows as doubles.

    Vectors shorter than ``width`` count as ending in zeros.
    """
    n = len(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become nan
    rows = np.repeat(np.arange(n), lengths)
    out = np.zeros((n, width))
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return lists.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(out).all(axis=1), out


def grouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows``; only the last has fewer."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        every = pa.Table.from_batches(held).combine_chunks()
        cut = count - count % rows
        for at in range(0, cut, rows):
            yield every.slice(at, rows).to_batches()[0]
        held = every.slice(cut).to_batches()
        count -= cut
    if count:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
