"""Lookup tables that a Python worker keeps from task to task: those of one operator at a time."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

_held: dict[int, dict] = {}


#: The C library's numbers of the settings below: memory freed at the top is returned from this size on, and so many heaps are kept.
M_TRIM_THRESHOLD, M_ARENA_MAX = -1, -8
_lean = False


def claim(*tables: dict) -> None:
    """From now on the worker holds these tables; others are emptied, as workers outlive their stage."""
    global _lean
    if not _lean:
        _lean = True
        _return_early()
    own = {id(t): t for t in tables}
    dropped = [key for key in _held if key not in own]
    for key in dropped:
        _held.pop(key).clear()
    if dropped:
        _give_back()
    _held.update(own)


def _return_early() -> None:
    """What is freed between batches goes back to the system soon, so that a worker's size follows what it holds."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        library = ctypes.CDLL(None)
        library.mallopt(M_ARENA_MAX, 1)
        library.mallopt(M_TRIM_THRESHOLD, 1 << 20)
    except AttributeError:
        pass


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass
