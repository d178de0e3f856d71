"""A bounded table chunk -> value that computes missing entries and keeps the ones in use."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class ChunkTable(dict):
    """``values_of([chunk])`` is computed once while the chunk stays in use.

    The table holds at most ``limit`` entries in two generations. When the young one is full it
    becomes the old one, and entries that are asked for again move back; the rest is forgotten
    and would be computed again. Results never depend on the limit.
    """

    def __init__(self, compute: Callable[[list], list], limit: int = 500_000):
        super().__init__()
        self._compute = compute
        self._half = max(1, limit // 2)
        self._old: dict = {}

    def values_of(self, chunks: list) -> list:
        """The values of ``chunks`` in order (never None); missing ones are computed in one call."""
        found = list(map(self.get, chunks))
        if None in found:
            old, missing = self._old, []
            for chunk in {c for c, f in zip(chunks, found, strict=True) if f is None}:
                if chunk in old:
                    self[chunk] = old[chunk]
                else:
                    missing.append(chunk)
            if missing:
                self.update(zip(missing, self._compute(missing), strict=True))
            found = list(map(self.__getitem__, chunks))
            if len(self) > self._half:
                self._old = dict(self)
                self.clear()
        return found
