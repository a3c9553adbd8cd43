"""Words, shingles and hashes of whole batches of texts, on the bytes of Arrow string columns.

Words are runs of bytes of one class. Every class used here treats all bytes of non-ASCII characters alike, so
cutting the UTF-8 bytes gives the same words as cutting the characters. A batch is handled in pieces of a few
million bytes; a text is never cut, so a piece is as long as its longest text at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII white space.
NOT_SPACE = ~_SPACE
#: a-z after lower-casing, digits and every non-ASCII byte.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """Spread 64-bit values differently for each seed."""
    return mix(x ^ mix(np.array([seed + 1], np.uint64) * _BASE))


@dataclass
class Texts:
    """Some texts of a batch: their bytes, and the rows they are in."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[Texts]:
    """A string column as consecutive pieces of whole texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Texts(row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end


@dataclass
class Words:
    """Words of some texts: where each begins and ends, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """One 64-bit value per word."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        begins = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        powers = np.ones(int(lengths.max()), np.uint64)
        np.multiply.accumulate(np.full(len(powers) - 1, _BASE), out=powers[1:])
        letters = _BYTE[self.data[place + np.repeat(self.starts, lengths)]]
        return mix(np.add.reduceat(letters * powers[place], begins) + lengths.astype(np.uint64))

    def shingles(self, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of ``size`` words as (text, first word, 64-bit value).

        ``short``: a text with fewer words, but not none, has its whole sequence as its only run.
        """
        words, text = self.hashes(), self.text
        whole = np.flatnonzero(np.arange(len(words)) + size <= self.first[1:][text]) if len(words) else np.zeros(0, int)
        value = np.zeros(len(whole), np.uint64)
        for k in range(size):
            value += words[whole + k] * _PLACE[k % 64] + _PLACE[(k + 1) % 64]
        text, value = text[whole], mix(value + np.uint64(size))
        if short and len(rest := np.flatnonzero((self.counts > 0) & (self.counts < size))):
            begin, count = self.first[rest], self.counts[rest]
            for n in np.unique(count):
                some, at = rest[count == n], begin[count == n]
                one = np.zeros(len(some), np.uint64)
                for k in range(int(n)):
                    one += words[at + k] * _PLACE[k % 64] + _PLACE[(k + 1) % 64]
                text, whole = np.concatenate([text, some]), np.concatenate([whole, at])
                value = np.concatenate([value, mix(one + np.uint64(n))])
            order = np.argsort(text, kind="stable")
            text, whole, value = text[order], whole[order], value[order]
        return text, whole, value


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased; a copy."""
    return _LOWER[data]


def words(texts: Texts, kind: np.ndarray) -> Words:
    """Words of the byte class ``kind`` after lower-casing A-Z."""
    data, offsets = _LOWER[texts.data], texts.offsets
    inside = kind[data]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))
