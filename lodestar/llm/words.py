"""64-bit hashes of the words of many texts at once, over their bytes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes of text that are hashed at once; a longer text is hashed alone.
CHUNK = 1 << 18

_BASE = 0x9E3779B97F4A7C15


class WordHashes:
    """The hash of a run of bytes: the sum of the bytes' numbers, each times a power of an odd constant for its place, mixed."""

    def __init__(self, seed: int):
        self.numbers = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed) for b in range(256)], np.uint64)
        self.powers = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = np.full(1 << n.bit_length(), _BASE, np.uint64)
            self.powers[0] = 1
            self.powers = np.cumprod(self.powers)

    def __call__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Of the runs data[starts[i]:stops[i]], which stand in order and apart."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        first, last = int(starts[0]), int(stops[-1])
        room = np.diff(starts, append=last)
        self._reach(int((stops - starts).max()))
        place = np.arange(first, last) - np.repeat(starts, room)
        place[place >= np.repeat(stops - starts, room)] = -1
        terms = self.numbers[data[first:last]] * self.powers[place]
        terms[place < 0] = 0
        h = np.add.reduceat(terms, starts - first)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def chunks(sizes: list[int]) -> list[tuple[int, int]]:
    """Ranges of texts of CHUNK bytes together, or of one longer text."""
    out, first, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > CHUNK:
            out.append((first, i))
            first, total = i, 0
        total += n
    return [*out, (first, len(sizes))] if sizes else out
