"""Word and n-gram hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

# ---- fixed values: 64-bit odd multipliers ----
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# ---- end of fixed values ----
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 to the 64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        inverse = pow(int(BASE), -1, 1 << 64)
        size = max(n, 1 << 21)
        for name, factor in (("up", int(BASE)), ("down", inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the words per text. A-Z are lower-cased first if asked for."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    begin, end = edge[0::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:len(data)], dtype=np.uint64)])
    hashes = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))
    bounds = np.cumsum([len(text) + 1 for text in texts])
    counts = np.diff(np.concatenate([[0], np.searchsorted(begin, bounds)]))
    return hashes, counts


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position on; windows may run over the end of a text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, seed, np.uint64)
    for i in range(size):
        total = total * BASE + words[i:i + n]
        if seed:
            total ^= total >> np.uint64(29)
    return mix(total)
