"""Words and marks of a text as hashed numbers, for the n-gram models."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_KNOWN_LIMIT = 500_000


def tokens(text: str | None) -> list[str]:
    """Lower-cased words, and runs of what is neither word nor space, in order."""
    return _TOKEN.findall(text.lower()) if text else []


class TokenHashes:
    """Stable hashes of tokens; those met before are kept, up to a limit."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def __call__(self, found: list[str]) -> np.ndarray:
        known, out = self._known, []
        if len(known) > _KNOWN_LIMIT:
            known.clear()
        for token in found:
            value = known.get(token)
            if value is None:
                value = known[token] = crc32(token.encode("utf-8", "replace"))
            out.append(value)
        return np.array(out, np.uint64)
