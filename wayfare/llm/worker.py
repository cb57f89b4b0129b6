"""Tables that a Python worker keeps from task to task.

Workers live as long as their executor and serve one stage after another. The table of one kind is kept at a
time, so that what a stage has gathered does not stay beside the tables of the next.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

Table = TypeVar("Table")

_kept: dict[Hashable, object] = {}


def kept(kind: Hashable, make: Callable[[], Table]) -> Table:
    """The worker's table of this ``kind``, made anew if it is not the last one asked for."""
    if kind not in _kept:
        _kept.clear()
        _kept[kind] = make()
    return _kept[kind]
