"""Word hashes of many texts at once.

A word is a maximal run of characters other than space and U+0009..U+000D,
lower-cased.  Its hash is a polynomial over its UTF-8 bytes modulo 2**64,
read off one running sum over the whole block, so the cost per byte is a few
vector operations and no per-word Python object is made.
"""

from __future__ import annotations

import numpy as np

from ticketlens.llm.common import mix64

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _power_table(base: int, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        step[0] = 1
        have = _powers[name] = np.multiply.accumulate(step)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of each byte span of ``data`` (uint8)."""
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    value = data.astype(np.uint64) + np.uint64(1)
    if salt:
        value = mix64(np.arange(257, dtype=np.uint64) * np.uint64(salt))[1:][data]
    np.cumsum(value * _power_table(_P, len(data), "up"), out=run[1:])
    h = (run[ends] - run[starts]) * _power_table(_P_INV, len(data), "down")[starts]
    return mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no gap; the last byte must be one."""
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(gap) and not gap[0]:
        edge = np.insert(edge, 0, 0)
    return edge[::2], edge[1::2]


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, offsets): text i has words[off[i]:off[i+1]]."""
    parts = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in texts]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    starts, ends = spans(SPACE[data])
    bounds = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=bounds[1:])
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (all words, if fewer)."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E6C63D0876A9A47) + words[j : n - size + 1 + j]
    return mix64(out)


NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x41:0x5B] = NOT_ALNUM[0x61:0x7B] = NOT_ALNUM[0x80:] = False
