"""Word and word-window names over blocks of texts, vectorised with numpy.

A name is a 64-bit hash that depends only on the bytes of the words, so equal
windows have equal names in every task without any exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_RNG = np.random.default_rng(20_240_501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P, _Q = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_STEP = 1 << 18
_powers: tuple[np.ndarray, np.ndarray] | None = None

#: ASCII white space separates; every other byte belongs to a word
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: digits, lower-case letters and all bytes from 0x80 (upper case is lowered first)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names in order."""
    return mix(a * _P + (b ^ (b >> np.uint64(32))) * _Q)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pa.compute.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray, wordy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words never cross texts."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = wordy[buf]
    first = np.empty(len(buf), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    cuts = offsets[:-1][offsets[:-1] < len(buf)]
    first[cuts] = True
    first &= inside
    last = np.empty(len(buf), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[cuts[cuts > 0] - 1] = True
    last &= inside
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A name per word: sums of byte values times powers of an odd base, shifted back to the word's start."""
    global _powers
    if _powers is None:
        up, down = np.full(2 * _STEP, _BASE), np.full(2 * _STEP, _UNBASE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    up, down = _powers
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # bounded temporary arrays
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _STEP, side="right")))
        lo, hi = int(starts[at]), int(ends[stop - 1])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        n = hi - lo
        if n > len(up):  # one very long word
            a, b = np.full(n, _BASE), np.full(n, _UNBASE)
            a[0] = b[0] = 1
            up_, down_ = np.cumprod(a), np.cumprod(b)
        else:
            up_, down_ = up, down
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf[lo:hi]] * up_[:n], out=sums[1:])
        out[at:stop] = mix((sums[e] - sums[s]) * down_[s] + (e - s).astype(np.uint64) * _Q)
        at = stop
    return out


class Windows:
    """Names of all windows of a given word count over one array of word names.

    ``names[n][p]`` is the name of words ``p .. p+n-1``; windows that would leave
    the array are missing at the end, windows that cross texts must be masked by
    the caller.
    """

    def __init__(self, words: np.ndarray) -> None:
        self._known = {1: words}

    def __getitem__(self, n: int) -> np.ndarray:
        if n not in self._known:
            half = 1 << ((n - 1).bit_length() - 1)  # the largest power of two below n
            a, b = self[half], self[n - half]
            m = max(0, len(self._known[1]) - n + 1)
            self._known[n] = pair(a[:m], b[half:half + m])
        return self._known[n]


def texts_of_words(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each text, and the word count at the end: the texts' offsets in words."""
    return np.searchsorted(starts, offsets)


def room(word_offsets: np.ndarray) -> np.ndarray:
    """For each word, how many words of its text follow it, itself included."""
    counts = np.diff(word_offsets)
    return np.repeat(word_offsets[1:], counts) - np.arange(word_offsets[-1])
