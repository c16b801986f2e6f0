"""Words and word-window hashes of a batch of texts, computed on whole byte
arrays (no Python object a word).

A word is a run of bytes other than space and 0x09-0x0D. A word's hash is a
polynomial over random 64-bit values of its bytes, a window's hash one over its
words' hashes; both come from prefix sums modulo 2**64 and are mixed at the end.
"""

from __future__ import annotations

import functools

import numpy as np

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASES = (np.uint64(0xD6E8FEB86659FD93 | 1), np.uint64(0xA0761D6478BD642F | 1))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; one array a base is kept and grown."""
    out = _POWERS.get(int(base), np.ones(1, np.uint64))
    while len(out) < n:
        out = np.concatenate([out, out * (out[-1:] * base)])
        _POWERS[int(base)] = out
    return out[:n]


@functools.cache
def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """A mixed hash of ``x``, another one for every salt."""
    return mix(x + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of several texts: byte spans in ``data``, hashes, and
    ``first[d]`` .. ``first[d + 1]`` the words of text d."""

    def __init__(self, texts: list[bytes | None], block: int = 1 << 17):
        self.data = b"\n".join([t or b"" for t in texts])
        raw = np.frombuffer(self.data, np.uint8)
        inside = ~_SEPARATOR[raw]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._sums: dict[int, np.ndarray] = {}
        ends = np.cumsum([len(t or b"") + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)]).astype(np.int64)
        self.hash = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):  # blocks of whole words bound the scratch arrays
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + block, "right")))
            low, high = int(self.start[at]), int(self.end[to - 1])
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE[raw[low:high]] * powers(_BASE, high - low), out=sums[1:])
            s, e = self.start[at:to] - low, self.end[at:to] - low
            self.hash[at:to] = mix((sums[e] - sums[s]) * powers(inverse(_BASE), high - low)[s] + (e - s).astype(np.uint64))
            at = to

    def __len__(self) -> int:
        return len(self.start)

    def document(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def spans(self, start: np.ndarray, length, which: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each ``start`` (word numbers)."""
        base = _BASES[which]
        if which not in self._sums:
            s = np.zeros(len(self) + 1, np.uint64)
            np.cumsum(self.hash * powers(base, max(1, len(self)))[: len(self)], out=s[1:])
            self._sums[which] = s
        s, length = self._sums[which], np.asarray(length, np.int64)
        return mix((s[start + length] - s[start]) * powers(inverse(base), max(1, len(self)))[start] + length.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def letters(texts: list[str | None]) -> list[bytes]:
    """Texts in lower case with every ASCII character but letters as a space."""
    return [(t or "").lower().encode().translate(_LETTERS) for t in texts]
