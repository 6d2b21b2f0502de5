"""Word shingles of a text as 63-bit hashes, computed with numpy on its bytes.

Words are runs of bytes other than space and 0x09-0x0D, after lower-casing A-Z. A word's hash is a polynomial of its
bytes modulo 2**64, taken from prefix sums over a block of the text, so that no Python code runs per word. Texts are
read whole, a block of about ``BLOCK`` bytes at a time: working memory is that of a block and 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0xD1342543DE82EF95


def _powers(base: int) -> np.ndarray:
    """The powers of the base for a block; longer stretches are handled block by block."""
    steps = np.full(BLOCK + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _long_word(data: np.ndarray) -> int:
    """The polynomial of one word that is longer than a block."""
    total = 0
    for at in range(0, len(data), BLOCK):
        part = data[at:at + BLOCK]
        total += int(np.sum(_BYTES[part] * _UP[:len(part)], dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return total & ((1 << 64) - 1)


def _blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    """Consecutive parts of at most ``BLOCK`` bytes, cut at white space, and longer words by themselves."""
    at = 0
    while len(data) - at > BLOCK:
        spaces = np.flatnonzero(_SPACE[data[at:at + BLOCK]])
        if len(spaces):
            stop = at + int(spaces[-1]) + 1
        else:
            stop = at + BLOCK
            while stop < len(data) and not _SPACE[data[stop:stop + BLOCK]].any():
                stop = min(stop + BLOCK, len(data))
            if stop < len(data):
                stop += int(np.argmax(_SPACE[data[stop:stop + BLOCK]]))
        yield data[at:stop]
        at = stop
    yield data[at:]


def _words(data: np.ndarray) -> np.ndarray:
    if len(data) > BLOCK:
        return np.array([_long_word(data)], dtype=np.uint64)
    space = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[data] * _UP[:len(data)], dtype=np.uint64)))
    return (sums[ends] - sums[starts]) * _DOWN[starts]


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    """A 64-bit hash per word, in the order of the text."""
    data = np.frombuffer(text.lower() if lower else text, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    parts = [_words(part) for part in _blocks(data)]
    return mix(parts[0] if len(parts) == 1 else np.concatenate(parts))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 63-bit hash per window of ``size`` consecutive words; if there are fewer words, one for the whole sequence;
    without words none."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    width = min(size, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = mix(total * _ODD + words[k:n - width + 1 + k])
    return (total >> np.uint64(1)).astype(np.int64)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of a text, in ascending order."""
    return np.unique(window_hashes(word_hashes(text), size))
