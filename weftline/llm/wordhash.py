"""Words as 64-bit hashes, and hashes of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers of the splitmix64 generator and of multiplicative hashing.
MIX_A, MIX_B, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def split(text: bytes | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in UTF-8: bytes.split() cuts at just these characters."""
    return text.split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def runs(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` values, for short runs."""
    n = len(values) - length + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(length if n > 0 else 0):
        out = out * STEP + values[k : k + n]
    return mixed(out)


def windows(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """A polynomial hash of each window of `length` values, by prefix sums modulo 2**64; `base` is odd."""
    n = len(values) - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    inverse = pow(base, -1, 1 << 64)
    powers = np.ones(len(values) + 1, dtype=np.uint64)
    powers[1:] = np.uint64(base)
    powers = np.cumprod(powers, dtype=np.uint64)
    back = np.ones(n, dtype=np.uint64)
    back[1:] = np.uint64(inverse)
    back = np.cumprod(back, dtype=np.uint64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers[: len(values)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * back)
