"""Models loaded by Python, once per worker process.

This module is imported by the workers, so what it holds lives as long as a
worker, across tasks; a function shipped with a task would bring a copy of its
own each time.
"""

from __future__ import annotations

from collections.abc import Callable

_LOADED: dict[str, object] = {}


def loaded(name: str, load: Callable[[], object]) -> object:
    """The model of that name; loaded when a worker first asks for it."""
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]
