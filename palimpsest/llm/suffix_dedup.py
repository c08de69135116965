"""Removal of passages that an earlier document holds, by sparse suffix arrays.

Suffixes at minimisers of a quarter of the passage are retained, sorted by their words within
ranges of their first ones, compared with their neighbours and extended to the left and right;
see ``suffix_array``.  What is moved, and how replies return, is described in ``repeats``.

Defined results: a passage is a word covered by ``size`` consecutive words that also start in a
document with a smaller id; longer passages are covered by several such windows.  A null or
empty text has no words; texts shorter than a passage are kept; among equal texts the smallest
id keeps its words; rows with equal ids do not remove each other's words; a row without an id
is kept whole and removes nothing; an empty table gives an empty one.  ``suffix_dedup`` reads
no other columns; ``cut_passages`` carries all of them through unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from palimpsest.llm.repeats import mark_repeats
from palimpsest.llm.substring_dedup import kept_words, spans
from palimpsest.llm.suffix_array import Suffixes
from palimpsest.llm.words import Words


def passages(size: int) -> Suffixes:
    """Minimisers of a quarter of the passage: rare enough words, and about 2/(3/4 size) kept."""
    return Suffixes(size, max(1, size // 4))


def suffix_dedup(docs: DataFrame, size: int = 50) -> DataFrame:
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
        bounds = list(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True))
        marks = [gone[a:b] for a, b in bounds]
        columns = [
            table["doc_id"],
            pa.array([len(m) for m in marks], pa.int64()),
            pa.array([int(m.sum()) for m in marks], pa.int64()),
            pa.array([kept_words(words, i, gone) for i in range(len(marks))], pa.binary()).cast(pa.string()),
            pa.array([spans(m).tolist() for m in marks], pa.list_(pa.list_(pa.int64()))),
        ]
        return pa.Table.from_arrays(columns, schema.names)

    return mark_repeats(rows, passages(size), output, schema)


def cut_passages(docs: DataFrame, size: int = 50) -> DataFrame:
    """The documents with repeated passages cut out of ``text``; ``n_chars`` follows, if there.

    White space between words that stay is kept as it is; a cut takes the white space after it.
    Rows of which nothing is cut are unchanged, and no row is dropped.
    """

    def output(table: pa.Table, words: Words, gone: np.ndarray) -> pa.Table:
        texts = table["text"].to_pylist()
        sizes = table["n_chars"].to_pylist() if "n_chars" in table.column_names else None
        ends = np.cumsum([len((t or "").encode()) for t in texts])
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if not gone[a:b].any():
                continue
            start, stop = int(ends[i - 1]) if i else 0, int(ends[i])
            kept, at = [], start
            for low, high in spans(gone[a:b]).tolist():
                kept.append(words.data[at : words.begin[a + low]].tobytes())
                at = int(words.begin[a + high]) if a + high < b else stop
            kept.append(words.data[at:stop].tobytes())
            texts[i] = b"".join(kept).decode()
            if sizes:
                sizes[i] = len(texts[i])
        column = table.column_names.index("text")
        table = table.set_column(column, "text", pa.array(texts, table.schema.field("text").type))
        if sizes:
            column = table.column_names.index("n_chars")
            table = table.set_column(column, "n_chars", pa.array(sizes, table.schema.field("n_chars").type))
        return table

    return mark_repeats(docs, passages(size), output, docs.schema)
