"""Objects that a Python worker builds once and keeps for its later tasks, and what it gives back."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_NAME = "_tavola_resident"


def resident(key: Any, build: Callable[[], Any]) -> Any:
    kept = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def give_back() -> None:
    """Return freed Arrow buffers to the machine; a worker that lives on would keep them."""
    pa.default_memory_pool().release_unused()
