"""Ids of repeated text pieces, looked up and put together as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np


class _Numbers(dict):
    """Piece to its number; an unknown piece gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class PieceTable:
    """Encodes texts given as lists of pieces; each distinct piece is encoded
    once by ``learn``, which returns the ids of a list of pieces one after
    another, and their counts. Beyond ``limit`` pieces the table starts anew
    before the next texts."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 dtype: np.dtype, limit: int):
        self.learn, self.dtype, self.limit = learn, np.dtype(dtype), limit
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.pool = np.empty(0, self.dtype)
        self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int32)

    def __len__(self) -> int:
        return len(self.numbers)

    def lookup(self, pieces: Iterable[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``n`` pieces one after another, and their counts."""
        at = np.fromiter(map(self.numbers.__getitem__, pieces), np.int32, n)
        if self.numbers.new:
            new, self.numbers.new = self.numbers.new, []
            ids, sizes = self.learn(new)
            first = len(self.pool) + np.cumsum(sizes) - sizes
            self.pool = np.concatenate([self.pool, ids.astype(self.dtype)])
            self.start = np.concatenate([self.start, first.astype(np.int32)])
            self.size = np.concatenate([self.size, sizes.astype(np.int32)])
        size = self.size[at]
        ends = np.cumsum(size, dtype=np.int64)
        where = np.arange(int(ends[-1]) if n else 0, dtype=np.int32)
        where += np.repeat(self.start[at] - (ends - size).astype(np.int32), size)
        return self.pool[where], size

    def encode(self, texts: Sequence[list[str]]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > self.limit:
            self.clear()
        per_text = np.fromiter(map(len, texts), np.int64, len(texts))
        flat, size = self.lookup(chain.from_iterable(texts), int(per_text.sum()))
        cuts = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[np.cumsum(per_text)]
        return np.split(flat, cuts[:-1]) if len(texts) else []
