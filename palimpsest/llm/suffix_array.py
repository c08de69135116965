"""Sparse suffix arrays over the words of all documents.

Of every window of ``size`` words the suffix is retained that begins with the window's minimiser,
the sequence of ``gram`` words with the lowest hash (the leftmost of equal ones).  The choice
depends on content alone, so equal windows retain suffixes at the same place, and about
2 / (size - gram + 2) of all positions are kept.

Buckets are ranges of the hash of a suffix's first ``gram`` words.  A block sends a bucket the
suffixes whose first words another document has too, each with the words that a match of
``size`` words can reach: ``size`` from its position on and ``size - gram`` before it.  The
bucket sorts its suffixes by their following words and compares neighbours, which gives the
length of the common prefix of any two as a minimum over what lies between; it does the same
with the words before them, read leftwards.  A match of ``size`` words that reaches ``k`` words
to the left of a suffix is then a run of prefixes of ``size - k`` words or more that is also
in a run to the left of ``k`` words or more.  For each ``k`` the reply tells whether a document
with a smaller id has that match; matches that overlap are joined into spans by the block.

Suffixes of one block with the same words around them are sent once, with their smallest id.
Words are compared by 40 bits of their hash and the first ``gram`` words by 64: two windows
that differ are taken for equal with a probability of about 1e-12 if they differ in one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from palimpsest.llm.repeats import BITS_ARROW, Block, from_planes, planes
from palimpsest.llm.words import U64, Words, mix

WORD_BYTES = 5
HEAD_BYTES = 8
CHUNK = 1 << 14  # suffixes whose surroundings are gathered at once


@dataclass(frozen=True)
class Suffixes:
    """Suffixes at minimisers of ``gram`` words in windows of ``size`` words."""

    size: int
    gram: int

    @property
    def reach(self) -> int:
        """Words beyond the first ``gram``, and words to the left, that a match can take in."""
        return self.size - self.gram

    def anchors(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first words of the retained suffixes, and their positions."""
        heads = words.sequence_hashes(self.gram)
        at = np.unique(self._lowest(heads)[words.windows(self.size)])
        return heads[at], at

    def _lowest(self, heads: np.ndarray) -> np.ndarray:
        """For every position that of the leftmost lowest hash of a window from there."""
        width, covered = self.reach + 1, 1
        low, place = heads.copy(), np.arange(len(heads))
        while covered < width:
            step = min(covered, width - covered)
            lower = np.flatnonzero(low[step:] < low[: max(len(low) - step, 0)])
            moved_low, moved_place = low[lower + step], place[lower + step]
            low[lower], place[lower] = moved_low, moved_place
            covered += step
        return place

    def open(self, buckets: int, number: int, rows: pa.Table) -> SuffixBlock:
        return SuffixBlock(self, buckets, number, rows)

    def answer(self, table: pa.Table) -> pa.Table:
        """For each suffix one bit for each number of words to the left."""
        raw = [x.as_py() for x in table["hashes"]]
        width = HEAD_BYTES + 2 * self.reach * WORD_BYTES
        lengths = [len(x) // width for x in raw]
        rows = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, width)
        del raw
        ids = np.concatenate([from_planes(x.as_py()) for x in table["ids"]]).view(np.int64)
        packed = np.packbits(self.matches(rows, ids), axis=1)
        bits, start = [], 0
        for n in lengths:
            bits.append(packed[start : start + n].tobytes())
            start += n
        columns = [
            table["block"],
            pa.array([2] * len(bits), pa.int32()),
            table["bucket"],
            pa.array(bits, pa.binary()),
        ]
        return pa.Table.from_arrays(columns, schema=BITS_ARROW)

    def matches(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Has a smaller id the match that reaches 0, 1, ... words to the left of a suffix?"""
        head = np.ascontiguousarray(rows[:, :HEAD_BYTES]).reshape(-1).view(U64)
        after = _Sorted(rows, head, range(self.reach))
        before = _Sorted(rows, head, range(self.reach, 2 * self.reach))
        found = np.zeros((len(rows), self.reach + 1), bool)
        for k in range(self.reach + 1):
            # Suffixes that lack a word there are alike too; the block leaves such windows out.
            run = after.runs(self.reach - k) * len(rows) + before.runs(k)
            order = np.lexsort((ids, run))
            run, id_ = run[order], ids[order]
            new = np.ones(len(run), bool)
            new[1:] = run[1:] != run[:-1]
            found[order, k] = id_ > id_[new][np.cumsum(new) - 1]
        return found


class _Sorted:
    """Suffixes in the order of some of their words, with the common lengths of neighbours."""

    def __init__(self, rows: np.ndarray, head: np.ndarray, columns: range) -> None:
        order = np.arange(len(rows))
        for j in reversed(columns):
            order = order[np.argsort(_column(rows, j)[order], kind="stable")]
        self.order = order = order[np.argsort(head[order], kind="stable")]
        alike = head[order[1:]] == head[order[:-1]]
        self.common = np.where(alike, 0, -1)
        for j in columns:
            column = _column(rows, j)[order]
            alike &= column[1:] == column[:-1]
            self.common += alike

    def runs(self, length: int) -> np.ndarray:
        """For each suffix the number of its run of neighbours with so much in common."""
        run = np.zeros(len(self.order), np.int64)
        run[self.order[1:]] = np.cumsum(self.common < length)
        return run


def _column(rows: np.ndarray, j: int) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    start = HEAD_BYTES + j * WORD_BYTES
    wide[:, :WORD_BYTES] = rows[:, start : start + WORD_BYTES]
    return wide.reshape(-1).view(U64)


class SuffixBlock(Block):
    """A block that sends the suffixes whose first words are shared."""

    anchors: Suffixes

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """Words after the first ``gram`` and, leftwards, before a suffix; 0 beyond its text."""
        text = self.words.text[at]
        low, high = self.words.first[text][:, None], self.words.first[text + 1][:, None]
        steps = np.arange(self.anchors.reach)
        places = np.concatenate([at[:, None] + self.anchors.gram + steps, at[:, None] - 1 - steps], axis=1)
        inside = (places >= low) & (places < high)
        found = np.maximum(self.words.hashes[np.where(inside, places, 0)] >> U64(64 - 8 * WORD_BYTES), U64(1))
        return np.where(inside, found, U64(0))

    def look_around(self, replies: pa.Table) -> None:
        """Find the shared suffixes, and the smallest id here of those that are alike."""
        shared = self.bits(replies, 1, self.sent)
        at, head = self.at[shared[self.of]], self.sent[self.of][shared[self.of]]
        factors = mix(np.arange(1, 4 * self.anchors.reach + 1, dtype=U64)).reshape(2, -1) | U64(1)
        prints = np.zeros((2, len(at)), U64)
        for start in range(0, len(at), CHUNK):
            part = self.surroundings(at[start : start + CHUNK])
            for i in range(2):
                prints[i, start : start + CHUNK] = (mix(part + factors[i]) * factors[1 - i]).sum(axis=1, dtype=U64)
        ids = self.ids[self.words.text[at]] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((ids, prints[1], prints[0], head))
        self.places, self.place_ids = at[order], ids[order]
        keys = (head[order], prints[0][order], prints[1][order])
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
        self.suffix = np.cumsum(new) - 1
        self.heads, self.example, self.smallest = keys[0][new], self.places[new], self.place_ids[new]

    def window_rows(self) -> Iterator[dict]:
        for bucket, part in self.bucket_slices(self.heads):
            sent = []
            for start in range(part.start, part.stop, CHUNK):
                stop = min(start + CHUNK, part.stop)
                around = self.surroundings(self.example[start:stop])
                raw = np.empty((stop - start, HEAD_BYTES + around.shape[1] * WORD_BYTES), np.uint8)
                raw[:, :HEAD_BYTES] = np.ascontiguousarray(self.heads[start:stop]).view(np.uint8).reshape(-1, 8)
                words = around.view(np.uint8).reshape(stop - start, -1, 8)[:, :, :WORD_BYTES]
                raw[:, HEAD_BYTES:] = words.reshape(stop - start, -1)
                sent.append(raw.tobytes())
            yield {
                "bucket": bucket,
                "block": self.number,
                "hashes": b"".join(sent),
                "ids": planes(self.smallest[part].view(U64)),
            }

    def repeated(self, replies: pa.Table) -> np.ndarray:
        """For every word whether a match of an earlier document covers it."""
        size, reach = self.anchors.size, self.anchors.reach
        width = (reach + 8) // 8
        found = np.zeros((len(self.heads), width), np.uint8)
        slots = dict(self.bucket_slices(self.heads))
        for row in replies.to_pylist():
            if row["step"] == 2:
                found[slots[row["bucket"]]] = np.frombuffer(row["bits"], np.uint8).reshape(-1, width)
        text = self.words.text[self.places] if len(self.places) else np.zeros(0, np.int64)
        room, end = self.places - self.words.first[text], self.words.first[text + 1]
        later = self.place_ids > self.smallest[self.suffix]
        marks = np.zeros(len(self.words.hashes) + 1, np.int64)
        for k in range(reach + 1):
            bit = (found[:, k // 8] >> (7 - k % 8)) & 1
            fits = (room >= k) & (self.places - k + size <= end)
            starts = self.places[fits & (later | bit.astype(bool)[self.suffix])] - k
            # Places differ, so no start is told twice here.
            marks[starts] += 1
            marks[starts + size] -= 1
        return np.cumsum(marks)[:-1] > 0
