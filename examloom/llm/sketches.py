"""Tables of fixed size about all rows: counters and bit maps, summed up in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from examloom.llm.common import partitions

CELL = 1 << 10  # bytes of a table per row while the tasks' tables are added up
SCHEMA = "cell long, part binary"
Hashes = Callable[[pa.RecordBatch], "Iterator[np.ndarray]"]


def _rows(cells: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in cells], pa.int64()), pa.array([p for _, p in cells], pa.binary())],
        ["cell", "part"])


def _table(rows: DataFrame, size: int, kind, fill, add) -> np.ndarray:
    """Sum of the tasks' tables.  Each task fills its own and gives the cells that are not
    zero; cells are shuffled and added, and the table, whose size is fixed, comes to the driver."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, kind)
        for batch in batches:
            fill(table, batch)
        parts = table.view(np.uint8).reshape(-1, CELL)
        used = np.flatnonzero(parts.any(axis=1))
        for start in range(0, len(used), 1024):
            yield _rows([(int(i), parts[i].tobytes()) for i in used[start:start + 1024]])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(raw, kind)
                sums[cell] = add(sums[cell], part) if cell in sums else part
        yield _rows([(c, p.tobytes()) for c, p in sums.items()])

    added = rows.mapInArrow(own, SCHEMA).repartition(partitions(rows.sparkSession), "cell").mapInArrow(together, SCHEMA)
    out = np.zeros(size, kind)
    parts = out.view(np.uint8).reshape(-1, CELL)
    for r in added.collect():  # one row per cell of the table
        parts[r["cell"]] = np.frombuffer(r["part"], np.uint8)
    return out


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def count_table(rows: DataFrame, hashes: Hashes, slots: int) -> np.ndarray:
    """How many hashes fall on each of `slots` counters (a power of two), up to 2^32 - 1."""
    top = np.uint64(2**32 - 1)

    def fill(table, batch):
        for h in hashes(batch):
            places, counts = np.unique(_slot(h, slots), return_counts=True)
            table[places] = np.minimum(table[places] + counts.astype(np.uint64), top)

    return _table(rows, slots, np.uint32, fill, lambda a, b: np.minimum(
        a.astype(np.uint64) + b, top).astype(np.uint32))


def counted(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return table[_slot(hashes, len(table))]


def bit_map(rows: DataFrame, hashes: Hashes, slots: int) -> np.ndarray:
    """Map of `slots` bits with those set that a hash falls on.  More hashes only fill it."""

    def fill(table, batch):
        for h in hashes(batch):
            s = _slot(h, slots)
            np.bitwise_or.at(table, s >> 3, (1 << (s & 7)).astype(np.uint8))

    return _table(rows, slots >> 3, np.uint8, fill, np.bitwise_or)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    s = _slot(hashes, len(bits) << 3)
    return (bits[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
