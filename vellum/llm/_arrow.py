"""Helpers of tasks over Arrow batches: runs of equal keys in sorted batches, and memory given back at a task's end."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(task: Task) -> Task:
    """The same task, which hands the memory that it has freed back to the system at its end.

    Python workers live on for tasks of other stages, and allocators keep freed pages for themselves.
    """

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return run


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys (the first ``n_keys`` columns) of sorted batches, one table each. Only the current run is held."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now])
        keys = list(zip(*(now.column(i).to_pylist() for i in range(n_keys)), strict=True))
        at = 0
        for i in range(1, len(keys)):
            if keys[i] != keys[at]:
                yield keys[at], now.slice(at, i - at)
                at = i
        held = now.slice(at)
    if held is not None and held.num_rows:
        yield tuple(held.column(i)[0].as_py() for i in range(n_keys)), held
