"""Removal of word sequences that an earlier document holds, by difference-cover anchors.

Anchor windows are hashed only at positions of a document that lie in a difference cover
modulo a period (3 of 7).  Whatever two places match over the full length, some shift of less
than the period takes both into the cover, so they share an aligned anchor, from which the
match is extended to full windows.  See ``repeats`` for what is moved.

Defined results: a null or empty text has no words and keeps an empty text; texts shorter than
a window are kept; among equal texts the smallest id keeps its words; rows with equal ids do
not remove each other's words; a row without an id is kept whole and removes nothing; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.repeats import DifferenceCover, mark_repeats
from palimpsest.llm.words import Words


def kept_words(words: Words, text: int, gone: np.ndarray) -> bytes:
    """The words of a text that stay, joined by one space."""
    here = slice(words.first[text], words.first[text + 1])
    stay = ~gone[here]
    begin, end = words.begin[here][stay], words.end[here][stay]
    low = int(begin[0]) if len(begin) else 0
    data = words.data[low : int(end[-1]) if len(end) else 0].tobytes()
    begin, end = begin - low, end - low
    return b" ".join([data[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)])


def spans(gone: np.ndarray) -> np.ndarray:
    """Runs of marked words as rows of begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return edges.reshape(-1, 2)


def substring_dedup(docs: DataFrame, size: int = 13) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, the kept words and the removed word spans."""
    rows = docs.select("doc_id", "text")
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
            T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )

    def output(table: pa.Table, words: Words, gone: np.ndarray) -> pa.Table:
        n = np.diff(words.first)
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[words.first[1:]] - total[words.first[:-1]]
        texts = [kept_words(words, i, gone) for i in range(len(n))]
        runs = [
            spans(gone[words.first[i] : words.first[i + 1]]).tolist() if removed[i] else []
            for i in range(len(n))
        ]
        columns = [
            table["doc_id"],
            pa.array(n, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(texts, pa.binary()).cast(pa.string()),
            pa.array(runs, pa.list_(pa.list_(pa.int64()))),
        ]
        return pa.Table.from_arrays(columns, schema.names)

    return mark_repeats(rows, DifferenceCover(size), output, schema)


def with_digest(found: DataFrame) -> DataFrame:
    """The kept words' SHA-256 in place of the kept words."""
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256")
    )
