"""What the Python workers keep from one task to the next."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa


def once(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, called once per process and key.

    This package's functions travel to the workers by value (see the
    package's ``__init__``), so every task brings its own copy of a module's
    globals; what is slow to build is kept with the interpreter instead.
    """
    kept = sys.__dict__.setdefault("_revmart_once", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def release_memory() -> None:
    """Give back to the system what Arrow's allocator keeps of earlier batches;
    a worker outlives its task and would hold it through later stages."""
    pa.default_memory_pool().release_unused()
