"""Arrays of whole Arrow batches of vectors, and blocks of rows that meet in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VECTOR = "array<double>"


def usable(embedding: Column) -> Column:
    """Not null, not empty, and every component finite."""
    return F.coalesce(
        (F.size(embedding) > 0)
        & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))),
        F.lit(False),
    )


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each stretch of equal keys of sorted batches; stretches may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(len(batch), bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def block_of(column: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def blocks_for(df: DataFrame, size: int) -> int:
    return max(1, -(-df.count() // size))
