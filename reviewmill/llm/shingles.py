"""Hashes of words and of word shingles, many texts at a time."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * step])
        step = step * step
    return out[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of all texts in order, and where each text's words begin (one more entry at the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    with np.errstate(over="ignore"):
        n = len(data)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers(_MUL, n), dtype=np.uint64)])
        words = mix((sums[ends] - sums[starts]) * powers(_INV, n)[starts] + (ends - starts).astype(np.uint64) * _ODD)
    return words, np.searchsorted(starts, first)


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles, A-Z lower-cased; fewer words than size make one shingle, no word none."""
    words, at = word_hashes([t.lower() for t in texts])
    with np.errstate(over="ignore"):
        m = max(0, len(words) - size + 1)
        h = np.zeros(m, np.uint64)
        for k in range(size):
            h = mix(h * _ODD + words[k : k + m])
        out = []
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= size:
                out.append(np.unique(h[a : b - size + 1]))
            elif b > a:
                one = np.uint64(b - a) * _MUL
                for w in words[a:b]:
                    one = mix(np.array([one * _ODD + w], np.uint64))[0]
                out.append(np.array([one], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
    return out
