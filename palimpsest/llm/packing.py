"""Packing token streams into sequences: concatenate and cut.

Pass one tokenises every document where it is read and writes its ids once to the shared
folder, together with the number of the task and the ids that the task wrote before.  Per task
there is one total; their prefix sums give each task its place in the concatenation of the
whole corpus.  Pass two reads the ids back and cuts at multiples of the window.  A document
that crosses a window's end, or a window that crosses from one task's documents to the next,
simply gives one piece on either side, so no task waits for another and nothing is shuffled
but the totals.  Only the last sequence can be shorter than the window.

Ids are those of ``tokenizers``.  Its byte-level pattern never matches across a place where a
space follows and precedes other characters, so a text is cut there and each distinct chunk is
encoded once per worker as long as a bounded memory holds it; texts that hold an added token
are encoded whole by the library.

Defined results: a null text counts as empty and gives the end id alone; every input row is
packed, repeated or without an id; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.memory import trim
from palimpsest.session import staged

#: Chunks that a worker keeps besides those of the batch at hand, and their length.
MEMORY_ENTRIES = 600_000
MEMORY_CHARS = 128
ROWS_AT_ONCE = 256
ENCODE_CHARS = 1 << 14
WIDTH = 4  # bytes of an id

# Unicode white space, as the byte-level pattern knows it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
OTHER_WHITE = re.compile(f"(?![ \n])[{WHITE}]")
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class Encoder:
    """The ids that ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives."""

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        split = spec["pre_tokenizer"] or {}
        model = spec["model"]
        self.chunked = (
            spec["normalizer"] is None
            and spec["post_processor"] is None
            and all(split.get(k) == v for k, v in BYTE_LEVEL.items())
            and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        self.added = [t["content"] for t in spec["added_tokens"]]
        # Characters of the byte-level alphabet stand for one byte each.
        self.lengths = np.zeros(max(model["vocab"].values()) + 1, np.int64)
        for piece, i in model["vocab"].items():
            self.lengths[i] = len(piece)
        self.plain: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, memory: dict[str, bytes], units: list[str], chunks: list[str]) -> None:
        """Encode chunks joined to longer texts; their bytes tell which ids belong to which."""
        start = 0
        while start < len(chunks):
            stop, chars = start, 0
            while stop < len(chunks) and (stop == start or chars + len(chunks[stop]) < ENCODE_CHARS):
                chars += len(chunks[stop])
                stop += 1
            some = chunks[start:stop]
            found = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            at = np.cumsum(self.lengths[ids])
            ends = np.searchsorted(at, np.cumsum([len(c.encode()) for c in some])) + 1
            buffer, begin = ids.tobytes(), 0
            for unit, end in zip(units[start:stop], (ends * WIDTH).tolist(), strict=True):
                memory[unit] = buffer[begin:end]
                begin = end
            start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned ids of each text."""
        if not self.chunked:
            return [self.whole(text) for text in texts]
        # Chunks of texts in which single spaces and line feeds stand between other
        # characters are those characters after a space, or after a line feed.
        plain: dict[int, list[str]] = {}
        spaced: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            lines = ("\n" + text).replace("\n", " \n")
            if not text or any(t in text for t in self.added):
                continue
            if "  " in lines or lines[-1] == " " or "\n " in lines or OTHER_WHITE.search(text):
                spaced[i] = CHUNK.findall(text)
            elif lines[-1] != "\n":
                plain[i] = lines[1:].split(" ")
        new = list(set().union(*plain.values()).difference(self.plain))
        self._learn(self.plain, new, [u if u[0] == "\n" else " " + u for u in new])
        new_spaced = list(set().union(*spaced.values()).difference(self.spaced))
        for chunk in new_spaced:
            self.spaced[chunk] = self.whole(chunk)
        one, other = self.plain.__getitem__, self.spaced.__getitem__
        feed = len(self.whole("\n"))
        found = []
        for i, text in enumerate(texts):
            if i in plain:
                found.append(b"".join(map(one, plain[i]))[feed:])
            elif i in spaced:
                found.append(b"".join(map(other, spaced[i])))
            else:
                found.append(self.whole(text))
        trim(self.plain, new, MEMORY_ENTRIES, MEMORY_CHARS)
        trim(self.spaced, new_spaced, MEMORY_ENTRIES, MEMORY_CHARS)
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Each document's ids and its place among the ids of the task that read it, written once."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("part", T.IntegerType()),
            T.StructField("place", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                doc_ids, texts = batch.slice(start, ROWS_AT_ONCE).columns
                ids = [x + end for x in encode(texts.to_pylist())]
                n = np.array([len(x) // WIDTH for x in ids], np.int64)
                places = place + np.cumsum(n) - n
                place += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(np.full(len(n), part, np.int32)),
                        pa.array(places),
                        pa.array(n),
                        pa.array(ids, pa.binary()),
                    ],
                    schema.names,
                )

    return staged(rows.mapInArrow(tokenise, schema), "token-ids", compression="zstd")


def pack(docs: DataFrame, path: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of documents in sequences of ``window`` ids, with the ids as little-endian bytes.

    ``start`` counts the document's ids before the piece, ``offset`` the ids of the sequence
    before it.  ``padded`` is the length to which the sequence is filled up: the window, or its
    own length where that is a power of two.
    """
    rows = tokenised(docs, path, end_id)
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per task that read documents, some 20 bytes each.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
        F.sum("tokens").over(Window.partitionBy()).alias("total"),
    )
    placed = rows.join(F.broadcast(bases), "part").select(
        "doc_id", "doc_tokens", "ids", "total", (F.col("base") + F.col("place")).alias("first")
    )
    last = F.col("first") + F.col("doc_tokens") - 1

    def piece(sequence):
        begin = F.greatest(F.col("first"), sequence * window)
        stop = F.least(last + 1, (sequence + 1) * window)
        start = begin - F.col("first")
        return F.struct(
            start.alias("start"),
            (stop - begin).alias("length"),
            F.substring("ids", (start * WIDTH + 1).cast("int"), ((stop - begin) * WIDTH).cast("int")).alias("ids"),
            sequence.alias("sequence_id"),
            (begin - sequence * window).alias("offset"),
            F.least(F.lit(window), F.col("total") - sequence * window).alias("filled"),
        )

    first_sequence = F.expr(f"first div {window}")
    last_sequence = F.expr(f"(first + doc_tokens - 1) div {window}")
    pieces = F.transform(F.sequence(first_sequence, last_sequence), piece)
    return placed.select("doc_id", "doc_tokens", F.inline_outer(pieces)).select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        "sequence_id",
        "offset",
        F.when(F.bit_count("filled") == 1, F.col("filled")).otherwise(window).alias("padded"),
    )


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "padded",
    )
