"""Hashed byte n-grams of texts, and linear models over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

#: Features that a sparse matrix is multiplied by at once; what that holds besides the matrix is some 100 MB.
AT_ONCE = 1 << 22
#: Texts are hashed in pieces of so many bytes, which overlap by what an n-gram needs.
PIECE = 1 << 20

_SAME = np.arange(256, dtype=np.uint32)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Grams:
    """Which n-grams of a text's UTF-8 bytes count as features, and how many buckets they fall into.

    White space is one byte, and stands before and after the text, so that n-grams tell where words begin and
    end. ``fold_case`` takes A-Z for a-z.
    """

    sizes: tuple[int, ...]
    bits: int
    fold_case: bool

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of the whole text, each once, in order, and how often each is met."""
        data = b" " + (text or "").encode("utf-8", "replace") + b" "
        if len(data) <= PIECE:
            return np.unique(self._hashed(data), return_counts=True)
        met = np.zeros(1 << self.bits, np.int64)
        for start in range(0, len(data), PIECE):
            met += np.bincount(self._hashed(data, start), minlength=len(met))
        buckets = np.flatnonzero(met)
        return buckets.astype(np.uint32), met[buckets]

    def _hashed(self, data: bytes, start: int = 0) -> np.ndarray:
        """The buckets of the n-grams that begin in the piece at ``start``."""
        part = data[start : start + PIECE + max(self.sizes) - 1]
        codes = (_LOWER if self.fold_case else _SAME)[np.frombuffer(part, np.uint8)]
        codes[(codes >= 9) & (codes <= 13)] = 32
        hashed, rolling = [], codes
        for n in range(1, max(self.sizes) + 1):
            if n > 1:
                rolling = rolling[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
            if n in self.sizes:
                x = (rolling + np.uint32(n)) * np.uint32(0x9E3779B1)
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x85EBCA77)
                hashed.append(x[:PIECE] >> np.uint32(32 - self.bits))
        return np.concatenate(hashed)


#: A text's features: buckets, in order, and their values.
Features = tuple[np.ndarray, np.ndarray]


@dataclass
class Rows:
    """A sparse matrix, row by row: the buckets of each row, and their values."""

    buckets: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: list[Features], width: int) -> Rows:
        """No row may be empty."""
        starts = np.append(0, np.cumsum([len(b) for b, _ in rows])[:-1])
        return cls(np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows]), starts, width)

    def _blocks(self) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
        """Some neighbouring rows, their features, where each begins among these, and its length."""
        ends = np.append(self.starts[1:], len(self.buckets))
        row = 0
        while row < len(ends):
            after = max(row + 1, int(np.searchsorted(ends, self.starts[row] + AT_ONCE, "right")))
            first, last = int(self.starts[row]), int(ends[after - 1])
            yield slice(row, after), slice(first, last), self.starts[row:after] - first, (ends - self.starts)[row:after]
            row = after

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [np.add.reduceat(weights[self.buckets[at]] * self.values[at], starts) for _, at, starts, _ in self._blocks()]
        )

    def transposed_times(self, each: np.ndarray) -> np.ndarray:
        total = np.zeros(self.width)
        for rows, at, _, lengths in self._blocks():
            total += np.bincount(self.buckets[at], np.repeat(each[rows], lengths) * self.values[at], self.width)
        return total

    def counts(self, each: np.ndarray) -> np.ndarray:
        """By bucket, the sum of ``each`` over the rows that have it."""
        total = np.zeros(self.width)
        for rows, at, _, lengths in self._blocks():
            total += np.bincount(self.buckets[at], np.repeat(each[rows], lengths), self.width)
        return total


def minimise(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 60, memory: int = 8
) -> np.ndarray:
    """Limited-memory quasi-Newton steps down a smooth loss, given with its gradient."""
    x, (value, slope) = start, loss(start)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, kept = -slope, []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            kept.append(a)
            way = way - a * y
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(kept)):
            way = way + (a - (y @ way) / (s @ y)) * s
        down, size = slope @ way, 1.0 if past else 1 / max(1.0, float(np.linalg.norm(slope)))
        for _ in range(30):
            there, (new, new_slope) = x + size * way, loss(x + size * way)
            if new <= value + 1e-4 * size * down:
                break
            size /= 2
        else:
            return x
        if (there - x) @ (new_slope - slope) > 1e-12:
            past = [*past[1 - memory :], (there - x, new_slope - slope)]
        settled = value - new < 1e-7 * max(1.0, abs(value))
        x, value, slope = there, new, new_slope
        if settled:
            break
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def pack(features: Features) -> bytes:
    return features[0].astype("<u4").tobytes() + features[1].astype("<f4").tobytes()


def unpack(data: bytes) -> Features:
    half = len(data) // 2
    return np.frombuffer(data[:half], "<u4"), np.frombuffer(data[half:], "<f4")
