"""What worker processes remember between tasks: the memory of one operator at a time.

Python workers serve the tasks of many operators one after another.  An operator that keeps
something for its next task says how it is forgotten (``remembers``); when a task of another one
begins (``begin``), it is, and freed memory goes back to the system.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

_FORGET: dict[str, Callable[[], None]] = {}
_now: list[str] = [""]


def remembers(name: str, forget: Callable[[], None]) -> None:
    _FORGET[name] = forget


def begin(name: str) -> None:
    """A task of operator ``name`` begins in this process."""
    if _now[0] == name:
        return
    _now[0] = name
    for other, forget in _FORGET.items():
        if other != name:
            forget()
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):        # another C library: it keeps what it frees
        pass


class Sized(dict):
    """Bytes for each key, the younger of two generations: it asks the older one and then ``learn``.  A
    generation has about ``limit`` bytes; keys over ``longest`` characters aren't kept."""

    #: of an entry, besides its key's and value's characters
    ENTRY = 170

    def __init__(self, learn: Callable, limit: int, longest: int):
        super().__init__()
        self.learn, self.limit, self.longest = learn, limit, longest
        self.old: dict = {}
        self.size = 0

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        if len(key) <= self.longest:
            self[key] = value
            self.size += self.ENTRY + len(key) + len(value)
        return value

    def age(self) -> None:
        """Between texts: the younger generation becomes the older one when it is full."""
        if self.size > self.limit:
            self.old = dict(self)
            self.clear()
            self.size = 0
