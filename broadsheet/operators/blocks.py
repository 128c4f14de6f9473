"""Rows packed into blocks of numbers, and blocks of numbers added up over all tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from broadsheet.functions.rows import pieces
from broadsheet.functions.vectors import sparse_parts
from broadsheet.session import durable

PACKED_ENTRIES = 1 << 16
PACKED = "size int, row binary, at binary, x binary, ordered binary"

SCHEMA = "key int, block binary"


def block_batches(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One batch for each block, so that no batch holds all of them twice."""
    for key, block in blocks.items():
        columns = [pa.array([key], pa.int32()), pa.array([np.ascontiguousarray(block, np.float64).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "block"])


def added_up(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sum of all blocks of each key, flat, from rows of ``SCHEMA``.

    Blocks are added as they stream into the task of their key, which holds one sum for each of its keys. The driver gets one
    block per key, so that keys and blocks must be bounded by parameters and not by the data.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(block)
                totals[key] = totals[key] + part if key in totals else part
        yield from block_batches(totals)

    return {r.key: np.frombuffer(r.block) for r in parts.repartition("key").mapInArrow(add, SCHEMA).toLocalIterator()}


@dataclass(frozen=True)
class Packed:
    """Some rows: the values ``x`` of their entries with ``row`` and column ``at`` of each, and the order of the entries by column.
    Rows that hold every column are a ``dense`` matrix instead."""

    size: int
    x: np.ndarray
    row: np.ndarray | None = None
    at: np.ndarray | None = None
    ordered: np.ndarray | None = None
    dense: np.ndarray | None = None


def packed_rows(df: DataFrame, width: int, vector: str = "row") -> DataFrame:
    """An ML vector column as ``PACKED`` rows on shared storage, for jobs that read all entries many times."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
            for start, stop in pieces(sizes, PACKED_ENTRIES):
                at, x = (c.slice(start, stop - start).flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
                lengths, arrays = sizes[start:stop], [x]
                if not ((lengths == width).all() and (at.reshape(-1, width) == np.arange(width)).all()):
                    arrays = [np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), at.astype(np.int32), x, np.argsort(at, kind="stable").astype(np.int32)]
                found = [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]
                none = pa.array([None], pa.binary())
                columns = [none, none, *found, none] if len(found) == 1 else found
                yield pa.RecordBatch.from_arrays([pa.array([len(lengths)], pa.int32()), *columns], names=["size", "row", "at", "x", "ordered"])

    positions, values = sparse_parts(vector)
    return durable(df.select(positions.alias("positions"), values.alias("values")).mapInArrow(pack, PACKED))


def unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Packed]:
    for batch in batches:
        for i in range(batch.num_rows):
            size, (row, at, x, ordered) = batch.column(0)[i].as_py(), (c[i].as_buffer() for c in batch.columns[1:])
            x = np.frombuffer(x)
            if row is None:
                yield Packed(size, x, dense=x.reshape(size, width))
            else:
                yield Packed(size, x, *(np.frombuffer(b, np.int32) for b in (row, at, ordered)))
