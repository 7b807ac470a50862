"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

K = 5
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_KNOWN_LIMIT = 500_000


class Shingler:
    """The distinct k-word shingles of a text: A-Z lower-cased, words split at ASCII white space."""

    def __init__(self, k: int = K) -> None:
        self.k = k
        self._known: dict[bytes, int] = {}

    def words(self, text: str | None) -> np.ndarray:
        known, out = self._known, []
        if len(known) > _KNOWN_LIMIT:
            known.clear()
        for word in text.encode("utf-8", "replace").translate(_LOWER).split() if text else ():
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh64_intdigest(word)
            out.append(value)
        return np.array(out, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted hashes; a text with fewer words is one shingle, one without words none."""
        h = self.words(text)
        size = min(self.k, len(h))
        if not size:
            return np.zeros(0, np.int64)
        state = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            state = (state ^ h[i: len(h) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            state ^= state >> np.uint64(32)
        found = np.sort(state.view(np.int64))
        return found[np.concatenate(([True], found[1:] != found[:-1]))]


def signature(found: np.ndarray) -> int:
    """One number for a whole set."""
    value = xxhash.xxh64_intdigest(found.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return int((a[at] == b).sum()) if len(a) else 0
