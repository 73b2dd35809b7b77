"""What a Python worker keeps between the tasks of one operator.

Spark gives a worker the tasks of later stages too, and an idle worker lives on beside them. A worker keeps one thing at a
time; operators that keep nothing let it go first, and give their own memory back when a task ends.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa

_kept: dict[Hashable, Any] = {}


def keep(key: Hashable, make: Callable[[], Any]) -> Any:
    """What is kept under ``key``, made if it is not there; anything else goes."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Drop what is kept and give free memory back to the machine, Arrow's and the C library's (where it can)."""
    if _kept:
        _kept.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator]) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """A task that keeps nothing: what was kept goes before it, and its free memory after it."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator:
        let_go()
        try:
            yield from run(batches)
        finally:
            let_go()

    return task
