"""What a Python worker keeps between tasks.

Spark reuses its workers, so the memory that one operator's tasks fill would stay while
another operator's tasks run.  Each owner gets a dictionary; the others' are let go.
"""

from __future__ import annotations

import ctypes

_KEPT: dict[str, dict] = {}


def keep_only(owner: str) -> dict:
    """The dictionary of ``owner``, empty at first; what other owners kept in this worker is freed."""
    others = [name for name in _KEPT if name != owner and _KEPT[name]]
    for name in others:
        _KEPT.pop(name).clear()
    if others:  # freed memory goes back to the system where the C library can do that
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return _KEPT.setdefault(owner, {})
