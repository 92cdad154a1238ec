"""Hashes of word shingles, many at a time."""

from __future__ import annotations

import re

import numpy as np

_WORDS = re.compile(r"[^\W_]+")
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORDS.findall(text.lower())


def mixed(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers that spreads them evenly; distinct ones stay distinct."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse, up to n at least."""
    if len(_POWERS[0]) <= n:
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            table = np.full(2 * n + 1, base, np.uint64)
            table[0] = 1
            _POWERS[i] = np.cumprod(table)
    return _POWERS[0], _POWERS[1]


def shingle_hashes(found: list[str], size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, repeats included, none if there are fewer words.

    A running polynomial over the bytes gives the value of any stretch as a difference; dividing by the
    power of its start makes it the same wherever the stretch stands.
    """
    n = len(found) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    parts = [word.encode() for word in found]
    line = np.frombuffer(b" ".join(parts) + b" ", np.uint8).astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[: n - 1]])
    power, inverse = _powers(len(line))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((line + np.uint64(1)) * power[: len(line)])])
    return mixed((running[ends[size - 1 :]] - running[starts]) * inverse[starts])
