"""What a Python worker remembers between rows, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterable


class Recent(dict):
    """A dictionary of two generations: when it is full the older one is forgotten, so that frequent keys stay."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.old: dict = {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def unknown(self, keys: Iterable) -> set:
        """The keys that have to be learned; first makes room if it is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        new = {k for k in set(keys) if k not in self}
        old = self.old
        self.update({k: old[k] for k in new if k in old})
        return new.difference(old)
