"""Words of a batch of texts as arrays: byte ranges and 64-bit hashes, without a loop over words.

A word is a run of bytes other than space and \\x09-\\x0D. Equal words have equal hashes; different words
share one with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: A random odd value for each byte; separators count nothing.
_VALUE = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[SEPARATOR] = 0

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and made anew only when a longer one is asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; a permutation."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """bytes: all texts, each followed by \\n. Word i is bytes[start[i]:end[i]]; text d has words first[d]:first[d+1]."""

    bytes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words(texts, lower: bool = False) -> Words:
    """Words of each text; None has none. lower: A-Z count as a-z."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    if lower:
        raw = LOWER[raw]
    inside = ~SEPARATOR[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    offset = np.zeros(len(encoded) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in encoded], out=offset[1:])
    first = np.searchsorted(start, offset)
    if len(start):
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(_VALUE[raw] * _power(_MULTIPLIER, len(raw)), start)
            h = mix(sums * _power(_INVERSE, len(raw))[start])
    else:
        h = np.zeros(0, np.uint64)
    return Words(raw, start, end, first, h)


def pieces(texts, size: int = 1 << 18):
    """Ranges of texts of about `size` characters, so that arrays of a batch stay small."""
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t or "") + 1
        if n >= size:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
