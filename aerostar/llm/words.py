"""Words and word n-grams as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MUL = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Words kept by a task before its table is emptied.
MOST_WORDS = 300_000


class WordHashes(dict):
    """word -> 64-bit hash, filled as words come up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def words(text: bytes | str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z lower-cased; null: none."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).lower().split()


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit permutation of each value, another for each salt."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _MUL[1]
    x = (x ^ (x >> np.uint64(27))) * _MUL[2]
    return x ^ (x >> np.uint64(31))


def hashes(tokens: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def direct_hashes(tokens: list[bytes]) -> np.ndarray:
    """The same hashes without a table: quicker where most words of a task are rare."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; of the whole sequence when it has 1..n-1 words."""
    if len(h) == 0:
        return h
    salt = min(n, len(h))
    m = len(h) - salt + 1
    out = np.zeros(m, dtype=np.uint64)
    for j in range(salt):
        out = out * _MUL[0] + h[j:j + m]
    return mix(out, salt)
