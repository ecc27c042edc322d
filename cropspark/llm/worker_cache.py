"""What a Python worker keeps from one task to the next.

Functions of this package travel with the job, so their module globals are made anew for each task.
Things that are dear to load are kept in a module of this name, which the worker holds as long
as it lives.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

HELD = "_cropspark_worker_cache"


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The value under `key`, made at the first call in this process."""
    held = sys.modules.setdefault(HELD, types.ModuleType(HELD)).__dict__.setdefault("values", {})
    if key not in held:
        held[key] = make()
    return held[key]
