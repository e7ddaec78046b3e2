"""What Python workers keep between tasks.

The modules with Python code for tasks travel with it by value, so executors need not have this package
installed. Their globals are new in every task then; what is dear to build is kept on the worker
process instead.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark import cloudpickle

_KEPT = "_tradewind_kept"


def travels_with_tasks(module: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module])


def _values() -> dict:
    return sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__.setdefault("values", {})


def remembered(key: tuple, make: Callable[[], Any]) -> Any:
    """The value made first under this key in this process."""
    kept = _values()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def latest(kind: str, key: str, make: Callable[[], Any]) -> Any:
    """The same for values of which a process keeps only the last of a kind."""
    kept = _values()
    if kept.get(kind, (None, None))[0] != key:
        kept.pop(kind, None)
        kept[kind] = (key, make())
    return kept[kind][1]


travels_with_tasks(__name__)
