"""Words of byte texts as codes into per-worker tables, so that what depends on a word alone is worked out once."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np


@lru_cache(maxsize=1)
def of_worker(kind: type, *arguments):
    """An object that all tasks of a worker share; it goes when another operator's takes its place, so that tables of words don't add up."""
    return kind(*arguments)


def clear_worker() -> None:
    """For tasks without such an object: what an earlier operator left in the worker goes."""
    of_worker.cache_clear()


class WordMemo:
    """Columns of numbers that ``describe`` gives for words, kept for up to ``limit`` words in a worker.

    The limit only bounds memory: the table starts anew when it is full, and results don't depend on it.
    """

    def __init__(self, describe: Callable[[list[bytes]], tuple[np.ndarray, ...]], limit: int = 600_000):
        self.describe, self.limit = describe, limit
        self.codes: dict[bytes, int] = {}
        self.columns: list[np.ndarray] = []

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """Codes of words, and the columns that they index."""
        if len(self.codes) > self.limit:
            self.codes, self.columns = {}, []
        new = [w for w in set(words) if w not in self.codes]
        used = len(self.codes)
        if new or not self.columns:
            described = self.describe(new)
            self.codes.update(zip(new, range(used, used + len(new))))
            if not self.columns:
                self.columns = [np.empty(0, c.dtype) for c in described]
            for i, column in enumerate(described):
                if used + len(new) > len(self.columns[i]):
                    self.columns[i] = np.concatenate([self.columns[i][:used], np.empty(max(used, 2 * len(new), 1024), column.dtype)])
                self.columns[i][used : used + len(new)] = column
        found = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        return found, tuple(self.columns)

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Number of words of each text, the codes of all words in order, and the columns."""
        split = [x.split() for x in texts]
        found, columns = self.look_up(list(chain.from_iterable(split)))
        return np.array([len(x) for x in split], np.int64), found, columns
