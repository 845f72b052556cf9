"""Texts of an Arrow batch as byte arrays: words, lines, shingles and hashes without Python strings.

A batch is cut into blocks of about a megabyte (a longer text is a block of its
own), so memory follows the longest text, not the batch. White space is the
ASCII one, ``[\\x20\\x09-\\x0D]``; all hashes are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

U64 = np.uint64
_PRIME = 0x9E3779B97F4A7C15 | 1
_PRIME_INVERSE = pow(_PRIME, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
CLOSING = np.zeros(256, bool)
CLOSING[list(b".,;:!?\"')]}")] = True
LEADING = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits depend on all bits of the input."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_PRIME, _PRIME_INVERSE)):
            steps = np.full(size, U64(base & (2**64 - 1)))
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers


class Block:
    """Consecutive texts: ``data`` their UTF-8 bytes, text i at ``offsets[i]:offsets[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """Number of marked bytes of each text."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that each byte position lies in."""
        return np.searchsorted(self.offsets, at, side="right") - 1

    @cached_property
    def is_word(self) -> np.ndarray:
        return ~SPACE[self.data]

    def _edges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        filled = self.offsets[:-1] < self.offsets[1:]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        firsts = self.offsets[:-1][filled]
        begin[firsts] = inside[firsts]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        lasts = self.offsets[1:][filled] - 1
        end[lasts] = inside[lasts]
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and owners of all words."""
        starts, ends = self._edges(self.is_word)
        return starts, ends, self.owner(starts)

    @cached_property
    def bare_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and owners of all words, A-Z lower-cased, without up to three closing marks."""
        starts, ends, owner = self.words
        for _ in range(3):
            ends = ends - ((ends - starts > 1) & CLOSING[self.data[ends - 1]]) if len(ends) else ends
        return self.hashes(starts, ends, fold=True), owner

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends (without the newline) and owners of the ``\\n``-split lines of texts that have bytes."""
        breaks = np.flatnonzero(self.data == 10)
        filled = self.offsets[:-1] < self.offsets[1:]
        starts = np.sort(np.concatenate((self.offsets[:-1][filled], breaks + 1)))
        ends = np.sort(np.concatenate((self.offsets[1:][filled], breaks)))
        owner = np.sort(np.concatenate((np.flatnonzero(filled), self.owner(breaks))))
        return starts, ends, owner

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
        """Hash of each byte span; ``fold`` takes A-Z as a-z."""
        power, inverse = _power_tables(len(self.data) + 1)
        sums = self._folded if fold else self._exact
        spans = (sums[ends] - sums[starts]) * inverse[starts]
        return mix(spans + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))

    def _prefix_sums(self, table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(table[self.data] * _power_tables(len(self.data) + 1)[0][: len(self.data)], dtype=U64, out=sums[1:])
        return sums

    @cached_property
    def _exact(self) -> np.ndarray:
        return self._prefix_sums(_BYTES)

    @cached_property
    def _folded(self) -> np.ndarray:
        return self._prefix_sums(_FOLDED)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and owners of the runs of ``size`` words, A-Z lower-cased; a shorter text is one run as a whole."""
        starts, ends, owner = self.words
        return runs(self.hashes(starts, ends, fold=True), owner, size)


def runs(values: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring values of one owner; owners with fewer values get one for all of them."""
    n = len(values)
    if not n:
        return values, owner
    counts = np.bincount(owner)
    full = np.flatnonzero(owner[: n - size + 1] == owner[size - 1:]) if n >= size else np.zeros(0, np.int64)
    out = np.zeros(len(full), U64)
    for k in range(size):
        out += values[full + k] * U64(pow(_PRIME, k + 1, 1 << 64))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(owner, short)
        whole = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = counts[short] > k
            whole[has] += values[first[has] + k] * U64(pow(_PRIME, k + 1, 1 << 64))
        whole += counts[short].astype(U64) * U64(0x8EBC6AF09C88C6E3)
        out, full_owner = np.concatenate((out, whole)), np.concatenate((owner[full], short))
        order = np.argsort(full_owner, kind="stable")
        return mix(out[order]), full_owner[order]
    return mix(out), owner[full]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string column in blocks; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Block(data[offsets[at]: offsets[end]], offsets[at: end + 1] - offsets[at], at)
        at = end
