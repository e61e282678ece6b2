"""Words as numbers: a growing list of distinct byte strings and the places of a text's words in it."""

from __future__ import annotations

import numpy as np


class Vocabulary(dict):
    """Words numbered in the order in which they are first met; ``words`` has them by number."""

    def __init__(self):
        super().__init__()
        self.words: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Growing:
    """A numpy array that is appended to; its room doubles when it is full."""

    def __init__(self, dtype: type):
        self.room, self.used = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        wanted = self.used + len(values)
        if wanted > len(self.room):
            more = np.empty(max(wanted, 2 * len(self.room)), self.room.dtype)
            more[: self.used] = self.values
            self.room = more
        self.room[self.used: wanted] = values
        self.used = wanted

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.used]


def split(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8: what space, tab, line feed, vertical tab, form feed and carriage
    return part. NULL has none; a lone surrogate, which is no character, counts as a question mark."""
    return text.encode("utf-8", "replace").split() if text else []
