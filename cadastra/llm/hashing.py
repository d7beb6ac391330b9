"""Vectorised hashes of words and character n-grams over the bytes of a text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: A long text is taken in pieces of about this many bytes, cut at white space where there is any.
PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of word characters: ASCII digits and letters, and all bytes of non-ASCII characters.
WORDLIKE = np.zeros(256, dtype=bool)
WORDLIKE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(n, _BASE, dtype=np.uint64)
    base[0] = 1
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    return _powers(1 << max(20, (n - 1).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits are usable."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix(b: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring of ``b`` follows."""
    out = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_letters()[b] * powers(len(b))[0][: len(b)], out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces, cut after white space; a longer run without any is cut anywhere."""
    at = 0
    while len(text) - at > size:
        window = text[at : at + size]
        end = max(window.rfind(b" "), window.rfind(b"\n")) + 1 or size
        yield window[:end]
        at += end
    yield text[at:]


def words(b: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which the table ``inside`` is true."""
    flags = np.zeros(len(b) + 2, dtype=np.int8)
    flags[1:-1] = inside[b]
    edges = np.flatnonzero(np.diff(flags))
    return edges[::2], edges[1::2]


def grams(b: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of each n-gram of bytes, by its start."""
    h = np.full(len(b) - n + 1, n, dtype=np.uint32)
    for j in range(n):
        h = h * np.uint32(0x01000193) ^ b[j : len(b) - n + 1 + j]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))) >> np.uint32(32 - bits)
