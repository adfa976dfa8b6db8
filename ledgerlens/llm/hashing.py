"""Seeded 64-bit hashing of words and shingles on numpy arrays."""

from __future__ import annotations

import re

import numpy as np

#: Multipliers of the splitmix64 mixing steps (fixed values).
GOLDEN, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Distinct words whose hashes a worker keeps at a time.
KEPT_WORDS = 500_000
WORDS = re.compile(r"\w+").findall


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the upper bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Shingler:
    """Distinct hashes of the runs of ``size`` words of a text, with how often each occurs.

    Words are runs of letters, digits and underscores, lower-cased. A text of fewer words,
    but at least one, has one shingle of all of them; one without words has none.
    """

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def runs(self, text: str | None) -> np.ndarray:
        import xxhash

        known, found = self.known, WORDS((text or "").lower())
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(found):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        if not len(h):
            return h
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, np.uint64(size), np.uint64)
        for i in range(size):
            out = mix(out * GOLDEN + h[i : len(h) - size + 1 + i])
        return out

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.runs(text), return_counts=True)
