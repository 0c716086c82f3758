"""Reading a sorted partition in pieces that never cut a run of equal keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of ``key`` (long, no nulls); the last run of a batch waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut or waiting and waiting[-1].column(key)[-1].as_py() != keys[0]:
            if waiting or cut:
                yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = []
        waiting.append(batch.slice(cut))
    if waiting:
        yield pa.Table.from_batches(waiting)


def run_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of equal values."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return begin, np.diff(begin, append=len(keys))
