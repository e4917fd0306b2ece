"""Hashes of words and of runs of words, for many texts in one numpy pass."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_REMEMBERED = 300_000


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words; one for all words if there are fewer."""
    size = min(size, len(hashes))
    if size == 0:
        return hashes
    rolled = hashes[: len(hashes) - size + 1].copy()
    for place in range(1, size):
        rolled *= _MULTIPLIER
        rolled += mix64(hashes[place : len(hashes) - size + 1 + place])
    return mix64(rolled + np.uint64(size))
