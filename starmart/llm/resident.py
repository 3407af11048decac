"""What a Python worker keeps between tasks: one model at a time, and no memory that it doesn't use.

Workers live on after a task and take tasks of other stages. A model (an automaton, a vocabulary with what it has
encoded) is built once in a worker and held until another operator's model, or ``release``, takes its place.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

Model = TypeVar("Model")
_held: dict[Hashable, object] = {}


def hold(key: Hashable, build: Callable[[], Model]) -> Model:
    """The model with this key, built if the worker doesn't hold it."""
    if key not in _held:
        release()
        _held[key] = build()
    return _held[key]  # type: ignore[return-value]


def release() -> None:
    """Let go of any model."""
    if _held:
        _held.clear()
        trim()


def trim() -> None:
    """Give freed memory back to the system: Arrow's, and the C library's where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
