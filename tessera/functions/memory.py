"""Memory of Python workers."""

from __future__ import annotations

import ctypes

import pyarrow as pa

_LIBC = ctypes.CDLL(None)


def release() -> None:
    """Give free memory back to the system: a Python worker outlives its task, and what it keeps adds to the next stage's."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)
