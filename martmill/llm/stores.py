"""What a Python worker keeps from task to task: the stores of one operator at a time.

Workers outlive tasks and stages. A store that speeds up one operator would otherwise stay in memory while the next
operator of a pipeline runs in the same worker.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """The store of this key in this worker, made at its first use; stores of other keys are dropped then."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same step over batches, after which a worker that waits, or runs no more, holds no memory for it."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def release() -> None:
    """Drops all stores and hands unused memory back to the system, as far as the allocators allow."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU C library has it
    if trim is not None:
        trim(0)
