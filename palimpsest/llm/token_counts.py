"""Token counts by the whole-token shortcut.

A sentencepiece BPE model never merges across a place where no vocabulary string can lie on
both sides.  ``Shortcut`` proves that from the vocabulary before any text is read: space
marks occur only at the front of pieces and no piece holds a line feed.  A text therefore
falls apart into *pre-tokens* (a run of spaces and the characters up to the next space or
line feed) whose counts add up.  The same pass over the vocabulary finds the strings that the
library itself encodes as exactly one token; pre-tokens of that kind are counted directly.
Only the others are merged by the library, each distinct one once per worker as long as a
bounded memory holds it.

Texts are counted in place in Arrow batches: nothing is shuffled, no text is cut short.

Defined results: a null text counts as empty, an empty text has no tokens; every input row
gives one row, repeated or without an id; an empty table gives an empty one; other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.memory import trim

#: Merged pre-tokens that a worker keeps besides those of the batch at hand, and their length.
MEMORY_ENTRIES = 600_000
MEMORY_CHARS = 128
#: Characters given to the library at once.
MERGE_CHARS = 1 << 16
ROWS_AT_ONCE = 256

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


class Shortcut:
    """Counts tokens as ``SentencePieceProcessor(model_file=path).encode`` does."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.model.vocab_size())
        pieces = [
            self.model.id_to_piece(i)
            for i in size
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        feed = self._encode("\n")
        self.separable = (
            not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
            and len(feed) == 2
            and self._encode("") == []
            and self._encode("a  b ") != self._encode("a b")
        )
        self.feed = feed[-1] if feed else -1
        self.whole = self._proven(pieces) if self.separable else {}
        self.plain, self.spaced = self.seed(True), self.seed(False)

    def _encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def _proven(self, pieces: list[str]) -> dict[str, int]:
        """The vocabulary strings that the library encodes alone as one token."""
        alone = [p for p in pieces if p]
        counts = self._merge([p.replace(MARK, " ") for p in alone])
        return {p: 1 for p, n in zip(alone, counts, strict=True) if n == 1} | {"\n": 1}

    def _merge(self, units: list[str]) -> list[int]:
        """Token counts of some strings, none of which holds a line feed.

        A line feed is a token of its own, so units are told apart in the ids of joined text.
        """
        counts: list[int] = []
        start = 0
        while start < len(units):
            stop, chars = start, 0
            while stop < len(units) and (stop == start or chars + len(units[stop]) < MERGE_CHARS):
                chars += len(units[stop]) + 1
                stop += 1
            ids = np.array(self._encode("\n" + "\n".join(units[start:stop])))
            ends = np.append(np.flatnonzero(ids == self.feed)[1:], len(ids))
            counts += np.diff(ends, prepend=1).tolist()
            counts[-len(ends) :] = [n - 1 for n in counts[-len(ends) :]]
            start = stop
        return counts

    def counts(self, texts: list[str]) -> list[int]:
        if not self.separable:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        plain: list[list[str]] = []
        spaced: list[list[str]] = []
        for text in texts:
            lines = text.replace("\n", " \n")
            if not text:
                plain.append([])
            elif "  " in lines or MARK in lines or lines[0] == " " or lines[-1] == " ":
                spaced.append(PRE_TOKEN.findall(MARK + text.replace(" ", MARK)))
                plain.append(spaced[-1])
            else:
                plain.append(lines.split(" "))
        odd = {id(row) for row in spaced}
        new = self._learn(self.plain, [r for r in plain if id(r) not in odd], True)
        new_spaced = self._learn(self.spaced, spaced, False)
        one, other = self.plain.__getitem__, self.spaced.__getitem__
        found = [sum(map(other if id(row) in odd else one, row)) for row in plain]
        trim(self.plain, new, MEMORY_ENTRIES, MEMORY_CHARS)
        trim(self.spaced, new_spaced, MEMORY_ENTRIES, MEMORY_CHARS)
        return found

    def seed(self, plain: bool) -> dict[str, int]:
        """The proven strings, as pre-tokens are spelled in texts with single spaces or others.

        In the former a pre-token has its space mark left out, and a line feed stays in front
        of what follows it.
        """
        if not plain:
            return dict(self.whole)
        marked = {p[1:]: 1 for p in self.whole if p[0] == MARK and p[1:] and p[1] != MARK}
        return marked | {"\n" + p: 2 for p in self.whole if p[0] != MARK and p != "\n"} | {"\n": 1}

    def _learn(self, memory: dict[str, int], rows: list[list[str]], plain: bool) -> list[str]:
        """Merge the pre-tokens that are neither proven nor remembered, and return them."""
        unknown = list(set().union(*rows).difference(memory))
        if plain:
            feeds = [u[0] == "\n" for u in unknown]
            texts = [u[1:] if f else " " + u for u, f in zip(unknown, feeds, strict=True)]
            counts = [n + f for n, f in zip(self._merge(texts), feeds, strict=True)]
        else:
            counts = self._merge([u.replace(MARK, " ") for u in unknown])
        memory.update(zip(unknown, counts, strict=True))
        return unknown


@lru_cache(maxsize=2)
def shortcut(path: str) -> Shortcut:
    return Shortcut(path)


def token_counts(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path`` names a sentencepiece model that every executor can open.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shortcut(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                ids, column = batch.columns
                texts = column.to_pylist()
                n_bytes = pa.compute.binary_length(column).cast(pa.int64())
                n_tokens = pa.array(counter.counts(texts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, n_bytes, n_tokens], schema.names
                )

    counted = rows.mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
