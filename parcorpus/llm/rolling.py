"""Karp-Rabin hashes of words and word runs over whole Arrow columns of text.

One pass of array operations hashes every word of a batch: with the running
sum of byte * base**position (modulo 2**64), a word's hash is the difference of
two sums, shifted back by the inverse power of its start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parcorpus.llm.common import ship_by_value

BASE, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: All ASCII but letters and digits: words without their punctuation.
PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())


def mixed(h):
    """Spread the bits of an array of 64-bit numbers over all places."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class WordHasher:
    """Hashes the words of texts: what stands between ``separators``, A-Z lower-cased."""

    def __init__(self, separators: bytes):
        codes = np.arange(1, 257, dtype=np.uint64)
        codes[65:91] = codes[97:123]
        codes[list(separators)] = 0
        self.codes = codes
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                    p = np.full(n, base, np.uint64)
                    p[0] = 1
                    setattr(self, name, np.multiply.accumulate(p))

    def words(self, column) -> tuple:
        """(hashes of all words, place of each text's first word and the end)."""
        return self.located(column)[:2]

    def located(self, column) -> tuple:
        """What :meth:`words` gives, the bytes of all texts, and each word's first and last place in them."""
        col = pc.fill_null(column, "").cast(pa.large_binary())
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        size = int(offsets[-1] - offsets[0]) if len(col) else 0
        if not size:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), np.zeros(len(col) + 1, np.int64), np.zeros(0, np.uint8), none, none
        data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        cuts = offsets - offsets[0]
        self._grow(size)
        code = self.codes[data]
        inside = code > 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin = cuts[:-1][cuts[:-1] < size]
        end = cuts[1:][cuts[1:] > 0] - 1
        first[begin], last[end] = inside[begin], inside[end]
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        sums = np.cumsum(code * self.power[:size], dtype=np.uint64)
        h = (sums[e] - sums[s] + code[s] * self.power[s]) * self.inverse[s]
        return mixed(h + (e - s).astype(np.uint64)), np.searchsorted(s, cuts), data, s, e


def runs(words, length: int):
    """Hash of every run of ``length`` words, by its first word (fewer than ``length`` words: none)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, length, np.uint64)
    for k in range(length):
        h = h * np.uint64(STEP) + words[k:k + n]
    return mixed(h)


ship_by_value(__name__)
