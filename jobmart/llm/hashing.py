"""Vectorised hashes of the words of many texts."""

from __future__ import annotations

import numpy as np

# one random number for each byte value, and powers for its place in the word
_BYTES = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[str], between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased, in
    order, and the number of words of each text.  ``between`` marks the byte values that
    stand between words (space among them)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = ~between[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = np.flatnonzero(start)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([[0], np.searchsorted(at, ends)]))
    if not len(at):
        return np.zeros(0, np.uint64), counts
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    size = np.flatnonzero(stop) + 1 - at
    longest = int(size.max())
    powers = np.cumprod(np.full(longest, _POWER, np.uint64))
    keep = np.flatnonzero(inside)
    place = np.arange(len(keep)) - np.repeat(np.cumsum(size) - size, size)
    value = _BYTES[_LOWER[data[keep]]] * powers[place]
    sums = np.add.reduceat(value, np.cumsum(size) - size)
    return mix64(sums + size.astype(np.uint64)), counts
