"""Tables of counters or bits of a fixed size, gathered over all tasks.

A task counts into an array and sends it in blocks of neighbouring counters, without
the blocks that are all zero.  Blocks are added where they meet, first as many times as
there are tasks, then by the driver, which receives each block once: the size of the
table bounds what it gets, not the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SCHEMA = "block long, counts binary"


def _packed(counts: np.ndarray) -> bytes:
    """Counters in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(counts: bytes, block: int) -> np.ndarray:
    return np.frombuffer(counts, f"u{len(counts) // block}").astype(np.int64)


def _rows(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    held = {i: _packed(n) for i, n in blocks.items() if n.any()}
    columns = [pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "counts"])


def count_table(
    rows: DataFrame, slots: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int, block: int = 1024
) -> np.ndarray:
    """How often each slot below ``size`` occurs; ``slots`` turns a batch into arrays of slot numbers."""
    whole = -(-size // block) * block

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(whole, np.int64)
        for batch in batches:
            for found in slots(batch):
                if len(found) > whole // 8:
                    total += np.bincount(found, minlength=whole)
                else:
                    np.add.at(total, found, 1)
        yield _rows(dict(enumerate(total.reshape(-1, block))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[at] = total.get(at, 0) + _unpacked(counts, block)
        yield _rows(total)

    summed = rows.mapInArrow(count, _SCHEMA).repartition("block").mapInArrow(add, _SCHEMA)
    out = np.zeros((whole // block, block), np.int64)
    for row in summed.collect():  # a row for each block
        out[row["block"]] += _unpacked(row["counts"], block)
    return out.ravel()[:size]


class Shipped:
    """A table on its way to the tasks, compressed: what goes with a function is written on every executor's disk."""

    def __init__(self, table: np.ndarray):
        self._kind, self._data = table.dtype.str, zlib.compress(table.tobytes(), 1)

    def open(self) -> np.ndarray:
        return np.frombuffer(zlib.decompress(self._data), self._kind)


def slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places for each key (unsigned 64 bits) in a table of ``1 << bits``."""
    other = keys * np.uint64(0xD6E8FEB86659FD93)
    return (keys >> np.uint64(64 - bits)).astype(np.int64), (other >> np.uint64(64 - bits)).astype(np.int64)


def bit_table(
    keys: DataFrame, bits: int, packed: bool = False, pick: Callable[[np.ndarray], np.ndarray] | None = None
) -> np.ndarray:
    """A table of ``1 << bits`` flags with both slots set of every key in a column of longs, or of their bytes if ``packed``.

    ``pick`` tells which of an array of keys (unsigned 64 bits) count; a step of its own
    before this one would take a second Python worker in every task.

    Whoever looks up a key finds both its slots set; a few others find that too, more of
    them the fuller the table, so it thins out rows before an exact join.
    """
    block = 1 << min(bits, 15)
    schema = "block long, flags binary"

    def rows(table: np.ndarray) -> pa.RecordBatch:
        blocks = table.reshape(-1, block)
        at = np.flatnonzero(blocks.any(axis=1))
        flags = [np.packbits(blocks[i]).tobytes() for i in at]
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flags, pa.binary())], ["block", "flags"])

    def merged(table: np.ndarray, found: list[tuple[int, bytes]]) -> None:
        for at, flags in found:
            table[at * block : (at + 1) * block] |= np.unpackbits(np.frombuffer(flags, np.uint8)).view(bool)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for batch in batches:
            column = batch.column(0)
            for part in column.to_pylist() if packed else [column.to_numpy().tobytes()]:
                found = np.frombuffer(part, np.uint64)
                for places in slots(found if pick is None else found[pick(found)], bits):
                    table[places] = True
        yield rows(table)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for batch in batches:
            merged(table, list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
        yield rows(table)

    gathered = keys.mapInArrow(mark, schema).repartition("block").mapInArrow(merge, schema)
    out = np.zeros(1 << bits, bool)
    merged(out, [(row["block"], row["flags"]) for row in gathered.collect()])  # a row for each block at most
    return out


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (signed or unsigned 64 bits) have both slots set."""
    one, two = slots(keys.view(np.uint64), len(table).bit_length() - 1)
    return table[one] & table[two]
