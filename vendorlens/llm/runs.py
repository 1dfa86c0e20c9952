"""Numpy views of sorted Arrow batches, cut only between groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


class Run(dict):
    """Columns by name as numpy arrays, sorted by ``keys``."""

    keys: list[str]

    def same_as_last(self) -> np.ndarray:
        """True where a row is in the group of the row before it."""
        n = len(self[self.keys[0]])
        same = np.ones(n, bool)
        same[:1] = False
        for k in self.keys:
            same[1:] &= self[k][1:] == self[k][:-1]
        return same


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[Run]:
    """The rows of batches sorted by ``keys``, in pieces that never split a
    group. Numeric columns without nulls."""
    held: list[pa.RecordBatch] = []
    names: list[str] = []

    def joined(parts: list[pa.RecordBatch]) -> Run:
        out = Run({c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in names})
        out.keys = keys
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        first = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            first[1:] = False
            for k in keys:
                col = batch.column(k).to_numpy(zero_copy_only=False)
                first[1:] |= col[1:] != col[:-1]
        last = int(np.flatnonzero(first)[-1])
        if held:
            # a group that began before may end in this batch, or go on past it
            if last == 0 and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys):
                held.append(batch)
                continue
            if last == 0:
                yield joined(held)
                held = [batch]
                continue
        if last:
            yield joined([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held = [*held, batch]
    if held:
        yield joined(held)
