"""Words of whole texts and hashes of word sequences, vectorised over many texts.

A word is a run of ``[^\\x20\\x09-\\x0D]``.  Its 64-bit hash is a polynomial over its bytes, each
byte standing for a random 64-bit value, taken from prefix sums and then mixed;
a window's hash is a polynomial over mixed word hashes in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes hashed at once
U64 = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Each byte with A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection whose output bits all depend on all input bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
#: Odd multipliers: of bytes in a word, of words in a window, and a second one of the latter.
FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a factor and of its inverse modulo 2^64."""
    known = _powers.get(factor)
    if known is None or len(known[0]) < n:
        size = max(n, SEGMENT + 1)
        both = []
        for base in (factor, pow(factor, -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            both.append(np.cumprod(p))
        known = both[0], both[1]
        if n <= SEGMENT + 1:
            _powers[factor] = known
    return known[0][:n], known[1][:n]


@dataclass
class Words:
    """Words of several texts: byte spans in ``data``, hashes, and the first word of each text."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # one more than there are texts

    @property
    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, size: int) -> np.ndarray:
        """Positions at which ``size`` words of one text begin."""
        n = np.diff(self.first)
        fits = np.maximum(n - size + 1, 0)
        before = np.cumsum(fits) - fits
        return np.arange(fits.sum()) - np.repeat(before - self.first[:-1], fits)

    def sequence_hashes(self, size: int, second: bool = False) -> np.ndarray:
        """For each position the hash of ``size`` words from there (0 near the end)."""
        out = np.zeros(len(self.hashes), U64)
        step = SEGMENT
        for start in range(0, len(self.hashes) - size + 1, step):
            part = self.hashes[start : start + step + size - 1]
            power, inverse = powers(FACTORS[1 + second], len(part))
            sums = np.zeros(len(part) + 1, U64)
            np.cumsum(part * power, out=sums[1:])
            n = len(part) - size + 1
            out[start : start + n] = mix((sums[size:] - sums[:n]) * inverse[:n])
        return out


def words_of(column: pa.StringArray, white: np.ndarray = WHITE, lower: bool = False) -> Words:
    """Words of every text of an Arrow string column; a null has none.

    ``white`` tells which bytes stand between words; ``lower`` takes A-Z as a-z.
    """
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = (
        np.frombuffer(column.buffers()[2], np.uint8)
        if column.buffers()[2] is not None
        else np.zeros(0, np.uint8)
    )
    base = int(offsets[0]) if len(offsets) else 0
    offsets = offsets - base
    data = data[base : base + int(offsets[-1])] if len(offsets) else data[:0]
    if lower:
        data = LOWER[data]
    begins, ends, hashes = [], [], []
    cuts = offsets[1:-1]
    at = 0
    while at < len(data):
        stop = _segment_end(data, at, white)
        begin, end, value = _hash(data[at:stop], cuts[(cuts > at) & (cuts < stop)] - at, white)
        begins.append(begin + at)
        ends.append(end + at)
        hashes.append(value)
        at = stop
    begin = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return Words(
        data,
        begin,
        np.concatenate(ends) if ends else np.zeros(0, np.int64),
        np.concatenate(hashes) if hashes else np.zeros(0, U64),
        np.searchsorted(begin, offsets),
    )


def _segment_end(data: np.ndarray, at: int, separators: np.ndarray) -> int:
    """An end of a segment that cuts no word."""
    stop = at + SEGMENT
    while stop < len(data):
        white = np.flatnonzero(separators[data[stop : stop + 4096]])
        if len(white):
            return stop + int(white[0])
        stop += 4096
    return len(data)


def _hash(data: np.ndarray, cuts: np.ndarray, white: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cuts] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    starts = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    ends = np.flatnonzero(inside & (~after[1:] | edge[1:])) + 1
    power, inverse = powers(FACTORS[0], len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTES[data] * power, out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * inverse[starts])
