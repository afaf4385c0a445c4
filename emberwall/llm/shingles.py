"""Word shingles of whole texts as 64-bit hashes, a block of texts at a time in numpy.

Words are runs of anything but ASCII white space, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed in one go; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[0x41:0x5B] += 32
_powers = {}


def power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, kept as far as needed yet (modulo 2 ** 64)."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n, BLOCK_BYTES) + 1, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Runs:
    """Runs of bytes outside ``gaps`` (a table of 256), with hashes of any parts of them."""

    def __init__(self, raw: np.ndarray, gaps: np.ndarray):
        gap = np.ones(len(raw) + 2, bool)
        gap[1:-1] = gaps[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self._sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(LOWER[raw] * power(BASE, len(raw))[: len(raw)], out=self._sums[1:])
        self._back = power(INVERSE, len(raw))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes between, A-Z lower-cased, wherever they stand."""
        value = (self._sums[end] - self._sums[start]) * self._back[start]
        return mixed(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the words in a byte array: start offsets and 64-bit hashes."""
    words = Runs(raw, _SPACE)
    return words.start, words.hashes(words.start, words.end)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; of fewer words (but any), one hash of them all."""
    n = min(size, len(words))
    out = np.full(len(words) - n + 1 if n else 0, np.uint64(n))
    for j in range(n):
        out = out * np.uint64(0x2545F4914F6CDD1D) + words[j: j + len(out)]
    return mixed(out)


def blocks(texts: Iterator[str | None]) -> Iterator[list[bytes]]:
    """Texts as UTF-8 (null: empty), gathered up to a block."""
    held, size = [], 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if held and size + len(raw) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield held


def shingle_sets(texts: Iterator[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in order."""
    for block in blocks(texts):
        raw = np.frombuffer(b"\n".join(block), np.uint8)
        start, words = word_hashes(raw)
        ends = np.searchsorted(start, np.cumsum([len(x) + 1 for x in block]) - 1)
        begin = 0
        for end in ends:
            yield np.unique(shingle_hashes(words[begin:end], size))
            begin = end
