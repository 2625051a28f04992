"""Python workers serve many tasks: what they keep between them, and what they hand back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_kept: dict[str, dict] = {}


def kept(work: str) -> dict:
    """What this worker keeps from task to task, until it turns to other work."""
    return _kept.setdefault(work, {})


def turn_to(work: str) -> None:
    """Let go of what other work has kept."""
    for name, held in _kept.items():
        if name != work:
            held.clear()


def hand_back() -> None:
    """Return freed memory to the system: allocators keep it, and the worker lives on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable, work: str = "") -> Callable:
    """run, whose worker holds no more after a task than what is kept for its work."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(work)
        try:
            yield from run(batches)
        finally:
            hand_back()

    return own
