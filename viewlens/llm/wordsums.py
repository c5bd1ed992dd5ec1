"""Sums of word vectors over texts, each distinct word computed once in a task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

#: Bytes of words and vectors that are remembered; beyond it they are forgotten and begun anew.
REMEMBERED_BYTES = 24 << 20
#: About what a word takes beside its characters and its vector.
WORD_BYTES = 100
#: Words whose vectors are computed or added up at once.
WORDS = 1 << 13


def ragged_sums(matrix: np.ndarray, rows: Sequence[Sequence[int]]) -> np.ndarray:
    """For each list of row numbers the sum of these rows of the matrix."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    out = np.zeros((len(rows), matrix.shape[1]))
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.fromiter((r for row in rows for r in row), np.int64, int(sizes.sum()))
        starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        out[full] = np.add.reduceat(matrix[flat], starts, axis=0, dtype=np.float64)
    return out


class WordSums:
    """``compute`` maps a list of words to a matrix, one row a word.

    It must not refer to what holds the sums: the vectors of a task would then stay
    in its worker until Python looks for cycles.
    """

    def __init__(self, width: int, compute: Callable[[list], np.ndarray]):
        self.width, self.compute = width, compute
        self.forget()

    def forget(self) -> None:
        self.number: dict = {}
        self.size = 0
        self.vectors = np.zeros((1024, self.width), np.float32)

    def bytes(self, words: Sequence) -> int:
        return sum(map(len, words)) + (WORD_BYTES + 4 * self.width) * len(words)

    def remember(self, new: Sequence) -> None:
        number, first = self.number, len(self.number)
        for i, w in enumerate(new, first):
            number[w] = i
        while len(number) > len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        for start in range(0, len(new), WORDS):
            part = new[start : start + WORDS]
            self.vectors[first + start : first + start + len(part)] = self.compute(part)

    def add_once(self, words: Sequence, distinct: list) -> tuple[np.ndarray, np.ndarray]:
        """As ``add``, remembering nothing."""
        number = {w: i for i, w in enumerate(distinct)}
        numbers = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        counts = np.bincount(numbers, minlength=len(distinct)).astype(np.float64)
        total = np.zeros(self.width)
        for start in range(0, len(distinct), WORDS):
            vectors = self.compute(distinct[start : start + WORDS]).astype(np.float32)
            total += counts[start : start + WORDS] @ vectors.astype(np.float64)
        return total, numbers

    def add(self, words: Sequence) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the vectors of the words of a text, and the words' numbers."""
        distinct = list(dict.fromkeys(words))
        new = [w for w in distinct if w not in self.number]
        size = self.bytes(new)
        if self.size + size > REMEMBERED_BYTES and self.number:
            self.forget()
            new, size = distinct, self.bytes(distinct)
        if size > REMEMBERED_BYTES:
            return self.add_once(words, distinct)
        self.size += size
        self.remember(new)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        distinct, counts = np.unique(numbers, return_counts=True)
        total = np.zeros(self.width)
        for start in range(0, len(distinct), WORDS):
            vectors = self.vectors[distinct[start : start + WORDS]].astype(np.float64)
            total += counts[start : start + WORDS].astype(np.float64) @ vectors
        return total, numbers
