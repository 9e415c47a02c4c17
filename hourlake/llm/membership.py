"""Bounded arrays gathered from all rows: counters of a sketch, and bit filters that tell which rows a join can need.

A filter lets rows through that are not needed, where hashes agree or it is full, and never stops one that is.
The join that follows decides; the filter only spares its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from hourlake.llm.common import alone, tidy

CHUNKS = 256
#: Bits of a filter.
FILTER = 1 << 25

SPARSE = "chunk int, at binary, value binary"


def sparse(values: np.ndarray) -> pa.RecordBatch:
    """An array as rows of SPARSE, without its zeros."""
    rows = [(c, at.astype(np.uint32).tobytes(), part[at].tobytes()) for c, part in enumerate(values.reshape(CHUNKS, -1)) if len(at := np.flatnonzero(part))]
    chunks, places, parts = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(places, pa.binary()), pa.array(parts, pa.binary())], ["chunk", "at", "value"])


def _added(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sum, which stops at the most that the type holds."""
    total = left + right
    return np.where(total < left, np.iinfo(left.dtype).max, total)


def merged(parts: DataFrame, total: int, dtype: str, add: bool) -> np.ndarray:
    """Rows of SPARSE joined by sum or by or on the executors, then gathered: `total` values, whatever the input."""
    width = total // CHUNKS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, at, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                into = held.setdefault(chunk, np.zeros(width, dtype))
                at, value = np.frombuffer(at, np.uint32), np.frombuffer(value, dtype)
                into[at] = _added(into[at], value) if add else into[at] | value
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["chunk", "value"])

    out = np.zeros(total, dtype)
    with tidy(parts.sparkSession):
        rows = parts.repartition("chunk").mapInArrow(alone(work), "chunk int, value binary").collect()
    for row in rows:
        out[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(row["value"], dtype)
    return out


def bit_filter(hashes: DataFrame) -> Broadcast:
    """The filter of a DataFrame's only column, of 64-bit hashes, sent to the executors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy() & (FILTER - 1)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield sparse(bits)

    bits = merged(hashes.mapInArrow(alone(work), SPARSE), FILTER // 8, "uint8", False)
    return hashes.sparkSession.sparkContext.broadcast(bits.tobytes())


def passing(held: Broadcast, hashes: pa.Array) -> pa.Array:
    """Which of the hashes the filter lets through."""
    at = hashes.to_numpy(zero_copy_only=False) & (FILTER - 1)
    bits = np.frombuffer(held.value, np.uint8)
    return pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)
