"""Runs of equal keys in a stream of sorted Arrow batches, and a union-find for one run."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

CHUNK_ROWS = 50_000


def whole_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int = CHUNK_ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that end where a run ends, with the start of each run; a run is never cut.

    Small batches are gathered to about ``least`` rows, so that short runs share their numpy calls.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= least:
            whole = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(whole, keys)
            if len(starts) > 1:
                cut = int(starts[-1])
                yield whole.slice(0, cut), starts[:-1]
                rest = whole.slice(cut)
                held, rows = rest.to_batches(), rest.num_rows
    if rows:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole, _starts(whole, keys)


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        column = rows.column(k).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


class Sets:
    """Union-find over 0..n-1; roots are the smallest members."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        """Unites left[i] with right[i] for every i."""
        if not len(left):
            return
        roots = self.roots()
        a, b = roots[left], roots[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        differ = low != high
        for code in np.unique(low[differ] * len(roots) + high[differ]).tolist():
            x, y = self._find(code // len(roots)), self._find(code % len(roots))
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def _find(self, x: int) -> int:
        while self.parent[x] != x:
            x = int(self.parent[x])
        return x
