"""Word handling that several corpus operators share."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)
_GAPS = str.maketrans({c: " " for c in "\x09\x0a\x0b\x0c\x0d"})
_ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Entries that a worker's word table holds before it starts anew; bounds its memory only.
TABLE_LIMIT = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """The words of a whole text; null has none."""
    if not text:
        return []
    return [w for w in text.translate(_GAPS).split(" ") if w]


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(_ASCII_LOWER)


class WordHashes(dict):
    """word -> stable 64-bit hash, remembered per worker, at most ``limit`` of them at a time."""

    def __init__(self, limit: int = TABLE_LIMIT):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def hash_array(table: WordHashes, words: list[str]) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mix64(hashes[:n] + _MIX)
    for k in range(1, width):
        out = mix64((out + _MIX) ^ hashes[k : k + n])
    return out


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter sequence is one shingle, an empty one none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(width, len(hashes))))
