"""Word sequences that an earlier document holds too: the exchange behind substring dedup.

A *window* is ``size`` consecutive words of one document.  A word is repeated if a window that
covers it also starts in a document with a smaller id.  Texts are moved once, as compressed
blocks of documents; all else that is moved are hashes and bits:

1. Each block sends the hashes of its *anchors*, short sequences chosen so that equal windows
   always hold equal anchors.  Hashes are dealt out to buckets; a bucket answers every block
   with one bit for each hash: does another document hold it?
2. Each block sends the hashes of the windows around such shared anchors, each with the
   smallest id that the block has for it.  The bucket answers with one bit: is there a smaller
   id elsewhere?  (``suffix_array`` sends suffixes here, which the bucket sorts and extends.)
3. Each block marks the words of the windows so answered.

A block sends each hash once however often it occurs, so a passage that a third of all rows
hold costs a bucket one entry for each block, not for each row, and needs no cap.  Bits go back
by block, in the order of the hashes sent.  Blocks are cut from the input in its order, which
has to be the same if a task runs again, as it is for files.

Anchor hashes are only a filter: what they let through wrongly is sorted out by the windows,
whose hashes have 64 bits besides those that choose the bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame

from palimpsest.llm.batches import bucket_count
from palimpsest.llm.words import U64, Words, words_of

BLOCK_BYTES = 2 << 20  # of text, unless one document has more
BLOCK_ROWS = 4096
BLOCKS = "block long, rows binary"
HASHES = "bucket int, block long, hashes binary, ids binary"
BITS = "block long, step int, bucket int, bits binary"
ANCHOR_BYTES = 5
BUCKET_BYTES = 16 << 20  # of input, as the optimizer estimates it


@dataclass(frozen=True)
class DifferenceCover:
    """Anchors at positions of a document that lie in a difference cover modulo a period.

    Any two positions have a common shift, less than the period, that takes both into the
    cover; so two equal windows hold an equal anchor at the same place in both.
    """

    size: int
    period: int = 7
    cover: tuple[int, ...] = (0, 1, 3)

    def __post_init__(self) -> None:
        reached = {(a - b) % self.period for a in self.cover for b in self.cover}
        if reached != set(range(self.period)) or self.period > self.size:
            raise ValueError("not a difference cover, or its period exceeds the window")

    def anchors(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors and their positions."""
        length = self.size - self.period + 1
        at = words.windows(length)
        member = np.zeros(self.period, bool)
        member[list(self.cover)] = True
        at = at[member[(at - words.first[words.text[at]]) % self.period]]
        return words.sequence_hashes(length)[at], at

    def around(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Positions of the windows that hold an anchor at one of these positions."""
        marks = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(marks, np.maximum(at - self.period + 1, 0), 1)
        np.add.at(marks, at + 1, -1)
        windows = words.windows(self.size)
        return windows[np.cumsum(marks)[windows] > 0]

    def open(self, buckets: int, number: int, rows: pa.Table) -> Block:
        return Block(self, buckets, number, rows)

    def answer(self, table: pa.Table) -> pa.Table:
        return _earlier(table)


def blocks(docs: DataFrame) -> DataFrame:
    """Documents in the order of the input, many in a row, compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            size = np.cumsum(pa.compute.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = int(size[start - 1]) if start else 0
                stop = int(np.searchsorted(size, done + BLOCK_BYTES, side="right"))
                stop = min(max(stop, start + 1), start + BLOCK_ROWS, batch.num_rows)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    ["block", "rows"],
                )
                number += 1
                start = stop

    return docs.mapInArrow(pack, BLOCKS)


class Anchors(Protocol):
    """How anchors are chosen, and what is compared around those that are shared."""

    size: int

    def anchors(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors and their positions."""

    def open(self, buckets: int, number: int, rows: pa.Table) -> Block:
        """A block of documents, ready to send and to be told."""

    def answer(self, table: pa.Table) -> pa.Table:
        """A bucket's reply to what the blocks send in the second step."""


@dataclass
class Block:
    """A block's words and what it sends and knows; built anew wherever it is needed."""

    anchors: Anchors
    buckets: int
    number: int
    rows: pa.Table

    def __post_init__(self) -> None:
        ids = self.rows.column("doc_id").combine_chunks()
        self.words = words_of(self.rows.column("text").combine_chunks())
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes, at = self.anchors.anchors(self.words)
        named = self.known[self.words.text[at]] if len(at) else np.zeros(0, bool)
        self.at = at[named]
        self.sent, self.of = np.unique(hashes[named], return_inverse=True)

    def bucket_slices(self, hashes: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Buckets of sorted hashes."""
        bucket = ((hashes >> U64(32)) * U64(self.buckets)) >> U64(32)
        edges = np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=U64))
        for k in np.flatnonzero(np.diff(edges)):
            yield int(k), slice(edges[k], edges[k + 1])

    def anchor_rows(self) -> Iterator[dict]:
        ids = self.ids[self.words.text[self.at]]
        limits = np.iinfo(np.int64)
        low, high = np.full(len(self.sent), limits.max), np.full(len(self.sent), limits.min)
        np.minimum.at(low, self.of, ids)
        np.maximum.at(high, self.of, ids)
        several = low < high
        keys = ((self.sent & U64((1 << 39) - 1)) << U64(1)) | several.astype(U64)
        raw = keys.view(np.uint8).reshape(-1, 8)[:, :ANCHOR_BYTES]
        for bucket, part in self.bucket_slices(self.sent):
            yield {"bucket": bucket, "block": self.number, "hashes": raw[part].tobytes(), "ids": None}

    def bits(self, replies: pa.Table, step: int, hashes: np.ndarray) -> np.ndarray:
        """The answers to one step, for the sorted hashes that were sent."""
        found = np.zeros(len(hashes), bool)
        places = dict(self.bucket_slices(hashes))
        for row in replies.to_pylist():
            if row["step"] == step:
                part = places[row["bucket"]]
                n = part.stop - part.start
                found[part] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=n)
        return found

    def look_around(self, replies: pa.Table) -> None:
        """Find the windows around shared anchors and the smallest id here for each sequence."""
        shared = self.bits(replies, 1, self.sent)
        windows = self.anchors.around(self.words, self.at[shared[self.of]])
        text = self.words.text[windows] if len(windows) else np.zeros(0, np.int64)
        windows, text = windows[self.known[text]], text[self.known[text]]
        size = self.anchors.size
        # The second hash chooses the bucket, the first is sent.
        chooser = self.words.sequence_hashes(size, second=True)[windows]
        key = self.words.sequence_hashes(size)[windows]
        order = np.lexsort((self.ids[text], key, chooser))
        self.windows, chooser, key = windows[order], chooser[order], key[order]
        self.window_ids = self.ids[text][order]
        new = np.ones(len(order), bool)
        new[1:] = (chooser[1:] != chooser[:-1]) | (key[1:] != key[:-1])
        self.sequence = np.cumsum(new) - 1
        self.chooser, self.key, self.smallest = chooser[new], key[new], self.window_ids[new]

    def window_rows(self) -> Iterator[dict]:
        for bucket, part in self.bucket_slices(self.chooser):
            yield {
                "bucket": bucket,
                "block": self.number,
                "hashes": planes(self.key[part]),
                "ids": planes(self.smallest[part].view(U64)),
            }

    def repeated(self, replies: pa.Table) -> np.ndarray:
        """For every word whether a window that an earlier document holds too covers it."""
        earlier = self.bits(replies, 2, self.chooser)
        flagged = earlier[self.sequence] | (self.window_ids > self.smallest[self.sequence])
        marks = np.zeros(len(self.words.hashes) + 1, np.int64)
        starts = self.windows[flagged]
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + self.anchors.size, -1)
        return np.cumsum(marks)[:-1] > 0


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compresses those that hardly differ."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(U64)


def _open(raw: pa.Scalar) -> pa.Table:
    with pa.ipc.open_stream(raw.as_buffer()) as reader:
        return reader.read_all()


def _table(rows: Iterator[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema)


HASHES_ARROW = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("ids", pa.binary())]
)
BITS_ARROW = pa.schema(
    [("block", pa.int64()), ("step", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())]
)


def _answers(table: pa.Table, step: int, lengths: list[int], answer: np.ndarray) -> pa.Table:
    bits, start = [], 0
    for n in lengths:
        bits.append(np.packbits(answer[start : start + n]).tobytes())
        start += n
    columns = [table["block"], pa.array([step] * len(bits), pa.int32()), table["bucket"], pa.array(bits, pa.binary())]
    return pa.Table.from_arrays(columns, schema=BITS_ARROW)


def _shared(table: pa.Table) -> pa.Table:
    """Which anchor hashes of a bucket do several documents hold?"""
    raw = [x.as_py() for x in table["hashes"]]
    packed = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, ANCHOR_BYTES)
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, :ANCHOR_BYTES] = packed
    keys = wide.reshape(-1).view(U64)
    order = np.argsort(keys >> U64(1), kind="stable")
    key, several = keys[order] >> U64(1), (keys[order] & U64(1)).astype(bool)
    same = key[1:] == key[:-1]
    hit = several
    hit[1:] |= same
    hit[:-1] |= same
    answer = np.zeros(len(keys), bool)
    answer[order] = hit
    return _answers(table, 1, [len(x) // ANCHOR_BYTES for x in raw], answer)


def _earlier(table: pa.Table) -> pa.Table:
    """For which window hashes of a bucket does another block know a smaller id?"""
    raw = [x.as_py() for x in table["hashes"]]
    keys = np.concatenate([from_planes(x) for x in raw])
    ids = np.concatenate([from_planes(x.as_py()) for x in table["ids"]]).view(np.int64)
    order = np.lexsort((ids, keys))
    key, id_ = keys[order], ids[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    smallest = id_[new][np.cumsum(new) - 1]
    answer = np.zeros(len(keys), bool)
    answer[order] = id_ > smallest
    return _answers(table, 2, [len(x) // 8 for x in raw], answer)


def mark_repeats(
    docs: DataFrame, anchors: Anchors, output: Callable[[pa.Table, Words, np.ndarray], pa.Table], schema
) -> DataFrame:
    """Apply ``output`` to blocks of documents, their words, and which words are repeated.

    ``docs`` needs ``doc_id`` and ``text``; further columns reach ``output`` unread.  A row
    without an id is neither compared nor changed; rows with equal ids are one document as far
    as comparing goes.
    """
    # Buckets and tasks grow with the input, so that none of them does.
    partitions = bucket_count(docs, 2 * BUCKET_BYTES)
    buckets = 2 * partitions
    texts = blocks(docs).repartition(partitions, "block")

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column(0), batch.column(1), strict=True):
                block = anchors.open(buckets, number.as_py(), _open(raw))
                yield from _table(block.anchor_rows(), HASHES_ARROW).to_batches()

    def known(left: pa.Table, right: pa.Table) -> Block:
        block = anchors.open(buckets, left["block"][0].as_py(), _open(left["rows"][0]))
        block.look_around(right)
        return block

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        return _table(known(left, right).window_rows() if left.num_rows else (), HASHES_ARROW)

    def compare(table: pa.Table) -> pa.Table:
        return anchors.answer(table)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        block = known(left, right)
        return output(block.rows, block.words, block.repeated(right))

    shared = texts.mapInArrow(send_anchors, HASHES).groupBy("bucket").applyInArrow(_shared, BITS)
    by_block = texts.groupBy("block")
    windows = by_block.cogroup(shared.groupBy("block")).applyInArrow(send_windows, HASHES)
    earlier = windows.groupBy("bucket").applyInArrow(compare, BITS)
    replies = shared.unionByName(earlier).groupBy("block")
    return by_block.cogroup(replies).applyInArrow(finish, schema)
