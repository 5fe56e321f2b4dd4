"""Word shingles as sorted arrays of 64-bit hashes, the same in every process."""

from __future__ import annotations

import numpy as np

M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, M1, np.uint64)]), dtype=np.uint64)
    return _powers


def hashed_words(b: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of each run of bytes that are ``inside`` a word."""
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    n = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, n)
    h = mix(np.add.reduceat((b[at].astype(np.uint64) + np.uint64(1)) * powers(int(n.max()))[place], first) + n.astype(np.uint64))
    return at[first], at[first] + n, h


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    return hashed_words(b, ~_SPACE[b])[2]


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words."""
    if len(h) < k:
        return h[:0]
    out = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        out = out * M1 + h[j : len(h) - k + 1 + j]
    return mix(out)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Distinct k-word shingles, sorted; all words as one if there are fewer; empty without words."""
    h = word_hashes(text)
    if not len(h):
        return h
    return np.unique(windows(h, min(k, len(h))))


def digest(x: np.ndarray, seed: int = 0) -> int:
    """A signed 64-bit hash of a set."""
    h = (int(mix(x * M1 + np.uint64(seed)).sum()) + len(x) * int(M2)) % (1 << 64)
    return h - (1 << 64) if h >> 63 else h
