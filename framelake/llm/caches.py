"""What a Python worker keeps from task to task, for one operator at a time."""

from __future__ import annotations

from collections.abc import Callable

_held: dict[str, Callable[[], None]] = {}


def claim(owner: str, clear: Callable[[], None]) -> None:
    """To be called by an operator before it fills a cache of its own in a worker. Workers are used again by
    later stages; what another operator has left behind is dropped then."""
    for other in [o for o in _held if o != owner]:
        _held.pop(other)()
    _held[owner] = clear
