"""Streaming over sorted groups whose rows may be spread over many partitions.

A table that is range-partitioned by group *and* further columns, and sorted by them, spreads a
hot group over tasks. Within one partition only the first and the last group can be cut by the
partition's bounds. `scan` hands over whole groups in batches, and puts rows of groups that may be
cut, or that are larger than a limit, aside; these are few groups (two per partition, and the
large ones), which the caller settles with a grouped aggregate and a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

Columns = list[np.ndarray]
GROUP_ROWS = 20_000


def _same(columns: Columns, n_keys: int, key: tuple) -> np.ndarray:
    same = np.ones(len(columns[0]), bool)
    for column, value in zip(columns[:n_keys], key):
        same &= column == value
    return same


def starts(columns: Columns, n_keys: int) -> np.ndarray:
    """Index of the first row of each group."""
    change = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns[:n_keys]:
        change |= column[1:] != column[:-1]
    return np.flatnonzero(np.append(True, change)) if len(columns[0]) else np.zeros(0, np.int64)


def scan(
    batches: Iterator[pa.RecordBatch],
    n_keys: int,
    whole: Callable[[Columns], Iterator[pa.RecordBatch]],
    aside: Callable[[Columns], pa.RecordBatch],
    limit: int = GROUP_ROWS,
) -> Iterator[pa.RecordBatch]:
    """Batches have columns without nulls, the first `n_keys` of which name the group."""
    held: Columns | None = None
    cut: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(c) for c in batch.columns]
        if held is not None:
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows)]
        if cut is None:
            cut = tuple(c[0] for c in rows[:n_keys])  # may have begun in another partition
        away = _same(rows, n_keys, cut)
        if away.any():
            yield aside([c[away] for c in rows])
            rows = [c[~away] for c in rows]
        held = rows
        if not len(rows[0]):
            continue
        last = starts(rows, n_keys)[-1]
        if last:
            yield from whole([c[:last] for c in rows])
        held = [c[last:] for c in rows]
        if len(held[0]) > limit:
            cut = tuple(c[0] for c in held[:n_keys])
            yield aside(held)
            held = [c[:0] for c in held]
    if held is not None and len(held[0]):  # may go on in the next partition
        yield aside(held)
