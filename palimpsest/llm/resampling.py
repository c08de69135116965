"""Importance resampling towards a target distribution of hashed n-grams.

A document's features are its runs of 1 to ``size`` consecutive words, each hashed to a bucket.
A bucket's gain is the log ratio of its smoothed shares in the target texts and in all
documents; a document's weight is the sum of gains over its features.  With Gumbel noise
from a hash of the id added, the highest scores are a draw without replacement in proportion to
the exponential of the weight.

*Interning.*  Each piece of a batch interns its n-grams in an open-addressed table of numpy
slots: the xxhash64 of an n-gram gives the first slot, bytes are compared where a slot is
taken, and what differs goes on to the next slot.  Slots hold bucket and count, so a bucket
is worked out once for each distinct n-gram; and the slot ids of the occurrences gather gains.

*Passes.*  One pass over documents and targets adds up bucket counts, combined in each task, so
only ``buckets`` rows for each task are moved and ``buckets`` rows reach the driver.  A second
pass weighs the documents.  The draw sorts narrow rows by ranges of score, numbers them
within each part and adds the parts' offsets; texts are not shuffled.

Defined results: a null or empty text has no features and weight 0; a row without an id has a
weight but no score, and neither counts for the draw nor is drawn; repeated rows are rows of
their own, and equal rows that straddle the edge of the draw get their ranks in any order; an
empty table gives an empty one, empty targets give weights from the smoothing alone; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.batches import slices
from palimpsest.llm.words import U64, words_of
from palimpsest.session import staged

#: Bytes between words: everything in ASCII but digits and small letters, A-Z being folded.
BETWEEN = np.zeros(256, bool)
BETWEEN[:128] = True
BETWEEN[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

# The primes of xxhash64.
P1, P2, P3, P4, P5 = (
    U64(0x9E3779B185EBCA87),
    U64(0xC2B2AE3D27D4EB4F),
    U64(0x165667B19E3779F9),
    U64(0x85EBCA77C2B2AE63),
    U64(0x27D4EB2F165667C5),
)
SHORT = 31  # bytes of an n-gram that are hashed and compared as vectors
OCCURRENCES = 1 << 18  # interned at once
PART_ROW = (1 << 33) - 1  # where monotonically_increasing_id keeps the row of a partition


def _left(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U64(bits)) | (x >> U64(64 - bits))


class Grams:
    """Byte spans in a buffer, with their first 32 bytes as lanes and their xxhash64."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.begin, self.end = begin, end
        self.size = (end - begin).astype(np.int64)
        self.data = np.concatenate((data, np.zeros(32, np.uint8)))
        self.lanes = self._lanes()
        self.keys = self._keys()

    def text(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()

    def _lanes(self) -> list[np.ndarray]:
        words = np.ndarray((len(self.data) - 7,), "<u8", self.data.data, strides=(1,))
        lanes = []
        for k in range(4):
            held = np.clip(self.size - 8 * k, 0, 8)
            at = np.minimum(self.begin + 8 * k, len(words) - 1)
            mask = np.where(held == 8, ~U64(0), (U64(1) << (8 * np.minimum(held, 7)).astype(U64)) - U64(1))
            lanes.append(words[at] & mask)
        return lanes

    def _keys(self) -> np.ndarray:
        n = self.size
        h = P5 + n.astype(U64)
        for k in range(3):
            mixed = _left((h ^ (_left(self.lanes[k] * P2, 31) * P1)), 27) * P1 + P4
            h = np.where(n >= 8 * k + 8, mixed, h)
        # What is left after whole lanes: four bytes, if there are, and single ones.
        whole = np.minimum(n // 8, 3)
        rest = np.choose(whole, self.lanes)
        left = n - 8 * whole
        four = left >= 4
        mixed = _left(h ^ ((rest & U64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        h = np.where(four, mixed, h)
        rest, left = np.where(four, rest >> U64(32), rest), np.where(four, left - 4, left)
        for k in range(3):
            mixed = _left(h ^ (((rest >> U64(8 * k)) & U64(0xFF)) * P5), 11) * P1
            h = np.where(left > k, mixed, h)
        h = (h ^ (h >> U64(33))) * P2
        h = (h ^ (h >> U64(29))) * P3
        h = h ^ (h >> U64(32))
        for i in np.flatnonzero(n > SHORT).tolist():
            h[i] = xxhash.xxh64_intdigest(self.text(i))
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of some spans equal those of others."""
        equal = self.size[a] == self.size[b]
        for lane in self.lanes:
            equal &= lane[a] == lane[b]
        for i in np.flatnonzero(equal & (self.size[a] > SHORT)).tolist():
            equal[i] = self.text(a[i]) == self.text(b[i])
        return equal


class Interned:
    """An open-addressed table of distinct n-grams; ``slots`` has the slot of each occurrence."""

    def __init__(self, grams: Grams, buckets: int):
        n = len(grams.keys)
        size = 1 << max(4, (2 * n).bit_length())
        first = np.full(size, -1, np.int64)
        self.slots = np.zeros(n, np.int64)
        todo, at = np.arange(n), (grams.keys & U64(size - 1)).astype(np.int64)
        while len(todo):
            slot = at[todo]
            free = first[slot] < 0
            first[slot[free]] = todo[free]
            holder = first[slot]
            hit = grams.keys[holder] == grams.keys[todo]
            hit[hit] = grams.same(holder[hit], todo[hit])
            self.slots[todo[hit]] = slot[hit]
            todo = todo[~hit]
            at[todo] = (at[todo] + 1) & (size - 1)
        self.taken = np.flatnonzero(first >= 0)
        self.count = np.bincount(self.slots, minlength=size)
        self.bucket = np.zeros(size, np.int32)
        raw, at = grams.data.tobytes(), first[self.taken]
        spans = zip(grams.begin[at].tolist(), grams.end[at].tolist(), strict=True)
        self.bucket[self.taken] = [zlib.crc32(raw[b:e]) % buckets for b, e in spans]


def features(column: pa.Array, size: int, buckets: int) -> Iterator[tuple[np.ndarray, Interned]]:
    """The texts of n-gram occurrences and their slots, a bounded number at once."""
    words = words_of(column, BETWEEN, lower=True)
    text = words.text
    for start in range(0, len(text), OCCURRENCES):
        stop = min(start + OCCURRENCES, len(text))
        data, begin, end = words.data, words.begin[start : stop + size - 1], words.end[start : stop + size - 1]
        if len(begin):
            data, low = data[begin[0] : end[-1]], begin[0]
            begin, end = begin - low, end - low
        if size > 1:
            data, begin, end = _joined(data, begin, end)
        for n in range(1, size + 1):
            first = np.arange(min(stop, len(text) - n + 1) - start)
            first = first[text[start + first] == text[start + first + n - 1]]
            if len(first):
                grams = Grams(data, begin[first], end[first + n - 1])
                yield text[start + first], Interned(grams, buckets)


def _joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words again, with one space after each."""
    length = end - begin
    new = np.cumsum(length + 1) - length - 1
    out = np.full(int((length + 1).sum()), 32, np.uint8)
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(new, length) + place] = data[np.repeat(begin, length) + place]
    return out, new, new + length


def bucket_counts(texts: DataFrame, size: int, buckets: int) -> DataFrame:
    """``bucket`` and ``n``, the features in it, of a table with a column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            for _, found in features(batch.column(0), size, buckets):
                np.add.at(total, found.bucket[found.taken], found.count[found.taken])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    parts = texts.select("text").mapInArrow(count, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, size: int, buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in the target and in all documents."""
    both = bucket_counts(docs, size, buckets).withColumn("side", F.lit(0))
    both = both.unionByName(bucket_counts(target, size, buckets).withColumn("side", F.lit(1)))
    counts = np.zeros((2, buckets))
    for row in both.collect():
        counts[row.side, row.bucket] = row.n
    s, t = counts
    share = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, size: int) -> DataFrame:
    """``doc_id``, ``n_features``, ``n_words`` and ``weight`` of every row."""
    buckets = len(gain)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            for text, found in features(batch.column(1), size, buckets):
                low, high = text[0], text[-1] + 1
                sums = np.concatenate(([0], np.cumsum(gain[found.bucket[found.slots]])))
                edges = np.searchsorted(text, np.arange(low, high + 1))
                weight[low:high] += sums[edges[1:]] - sums[edges[:-1]]
                n[low:high] += np.diff(edges)
            words = np.diff(words_of(batch.column(1), BETWEEN, lower=True).first) if size > 1 else n
            columns = [batch.column(0), pa.array(n), pa.array(words, pa.int64()), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    schema = f"doc_id {id_type}, n_features long, n_words long, weight long"
    return docs.select("doc_id", "text").mapInArrow(weigh, schema)


def numbered(rows: DataFrame, order: Callable[[], list], name: str) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in the whole order, by ranges and offsets."""
    keys = order()
    parts = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = staged(parts.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r.part: r.n for r in parts.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for k in sorted(sizes):
        offsets.append((k, before))
        before += sizes[k]
    # One row for each part of the shuffle.
    table = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    placed = parts.withColumn("part", part).join(F.broadcast(table), "part", "left")
    place = F.col("before") + F.col("_at").bitwiseAND(F.lit(PART_ROW)) + 1
    return placed.withColumn("place", place).drop("_at", "part", "before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    size: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn)."""
    rows = weighed(docs, gains(docs, target, size, buckets), size)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    usable = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    rows = rows.withColumn("score", F.col("weight") + noise).withColumn("usable", usable)
    ordered = lambda: [F.desc("usable"), F.desc("score"), F.asc("doc_id")]
    # Written first: ranges are found in one pass and dealt out in another.
    rows = numbered(staged(rows, "weights"), ordered, "resampling")
    drawn = rows.filter("usable").count() * percent // 100
    rank = F.when(F.col("usable") & (F.col("place") <= drawn), F.col("place"))
    return rows.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
