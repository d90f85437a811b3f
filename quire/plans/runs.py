"""Working on runs of equal keys in sorted Arrow batches, many small groups to a call."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables holding only whole runs of `key`, with the runs' bounds.  The batches must be sorted by an int64 key.

    Memory is that of one batch plus the longest run, so long runs must be split before.
    """
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        if kept and k[-1] == kept[0].column(key)[0].as_py():
            kept.append(batch)  # one run all through
            continue
        last = int(np.searchsorted(k, k[-1]))
        done = [*kept, batch.slice(0, last)]
        kept = [batch.slice(last)]
        table = pa.Table.from_batches(done)
        if table.num_rows:
            yield table, bounds(table.column(key).to_numpy())
    if kept:
        table = pa.Table.from_batches(kept)
        yield table, bounds(table.column(key).to_numpy())


def bounds(k: np.ndarray) -> np.ndarray:
    """Starts of the runs in k, and its length."""
    return np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])


def pairs_within(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs i < j inside each run; the runs must be short."""
    left, right = [], []
    sizes = np.diff(starts)
    for n in np.unique(sizes[sizes > 1]):
        a, b = np.triu_indices(int(n), 1)
        base = starts[:-1][sizes == n][:, None]
        left.append((base + a).ravel())
        right.append((base + b).ravel())
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)
