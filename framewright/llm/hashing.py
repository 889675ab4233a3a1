"""Vectorised hashes of words and word windows.

A word's hash is a sum of random 64-bit values of its bytes times powers of an odd number, modulo 2^64, so that one
running sum over a buffer of many texts gives the hashes of all its words, and one over the words those of all windows
of any length. Equal sequences get equal hashes everywhere.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4D | 5
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pow(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i below n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        _powers[base] = tuple(made)
    return _powers[base]


class Words:
    """The words of some texts: hash, byte span (in ``buffer``, texts joined by a newline) and text of each.

    space: by byte, whether it parts words; a newline must.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, space: np.ndarray = _space):
        self.buffer = b"\n".join(texts)
        raw = np.frombuffer(self.buffer, np.uint8)
        if lower:
            raw = _lower[raw]
        inside = ~space[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.starts, self.ends = edge[::2], edge[1::2]
        power, inverse = _pow(_BASE, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_values[raw] * power[: len(raw)], out=sums[1:])
        self.hashes = mix64((sums[self.ends] - sums[self.starts]) * inverse[self.starts])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        #: Number of the first word of each text, and of all words at the end.
        self.first = np.append(np.searchsorted(self.starts, np.cumsum(sizes + 1) - sizes - 1), len(self.starts))
        self.counts = np.diff(self.first)
        self._sums = None

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the n-word windows, by number of their first word; whether the window is within one text)."""
        total = len(self.hashes)
        if self._sums is None:
            self._sums = np.zeros(total + 1, np.uint64)
            np.cumsum(self.hashes * _pow(_WORD_BASE, total + 1)[0][:total], out=self._sums[1:])
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        s = self._sums
        h = mix64((s[n:] - s[: total - n + 1]) * _pow(_WORD_BASE, total + 1)[1][: total - n + 1] + np.uint64(n))
        last = np.repeat(self.first[1:], self.counts) - n
        return h, np.arange(total - n + 1) <= last[: total - n + 1]


def pack5(x: np.ndarray) -> bytes:
    """The low 40 bits of each value."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack5(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()
