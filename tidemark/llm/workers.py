"""What a Python worker keeps between tasks: the things of one operator at a time.

Workers are reused by later stages; a vocabulary or cache that another operator left
would stay for good."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_held: dict[str, dict] = {}


def held(owner: str) -> dict:
    """The dict that ``owner`` keeps things in; what others keep goes."""
    if owner not in _held:
        release()
        _held[owner] = {}
    return _held[owner]


def release() -> None:
    """Drop what is kept and give the memory back to the system."""
    if _held:
        _held.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass


def trimmed(each: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``each`` (of ``mapInArrow``), after whose last batch freed memory goes back: the
    worker stays, idle or at another operator's work, beside the executor's heap."""
    def run(batches):
        yield from each(batches)
        trim()

    return run
