"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text (``STATISTICS``) are worked out once per document, vectorised over
batches, and written to the shared folder; the text is read once and never moved.  The trees
are fitted on the statistics of labelled rows outside the held-out fold, at most
``fit_rows`` of them (those with the smallest hashes of their ids), which is the one thing
that comes to the driver.  Each statistic is cut into bins at quantiles; a tree grows level by
level, choosing for every node the bin edge with the largest gain from histograms of gradients.
All trees are flattened into arrays of split statistic, threshold and leaf value, in heap order,
and traversed for all rows of a batch and all trees at once.

Defined results: a null or empty text has all statistics 0 and is scored like any other; every
row is scored, repeated or without an id; rows without id or quality teach nothing, and an id
labelled several times counts with its least label; without usable labels, or with one kind
only, every score is the smoothed share of good rows; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.words import words_of
from palimpsest.session import staged

STATISTICS = (
    "log_words", "log_bytes", "word_bytes", "longest_word", "upper", "lower", "digit", "exclamation",
    "stop_comma", "symbol", "other_punctuation", "non_ascii", "line_feeds", "short_words",
    "distinct_words", "equal_to_previous", "commonest_word", "distinct_triples", "distinct_pairs",
    "upper_start", "words_with_symbol",
)

ROWS_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 20
FOLDS = 5

# Kinds of bytes.
UPPER, LOWER, DIGIT, EXCLAMATION, STOP, SYMBOL, OTHER, HIGH, FEED, WHITE = range(10)
KIND = np.full(256, OTHER, np.int64)
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[ord("!")] = EXCLAMATION
KIND[[ord(c) for c in ".,"]] = STOP
KIND[[ord(c) for c in "#*$%&|<>"]] = SYMBOL
KIND[128:] = HIGH
KIND[[9, 11, 12, 13, 32]] = WHITE
KIND[10] = FEED


def _distinct(text: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct values each text has, and how often the commonest occurs."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, text[starts], np.diff(np.append(starts, len(text))))
    return np.bincount(text[starts], minlength=texts), most


def statistics(column: pa.StringArray) -> np.ndarray:
    """One row of ``STATISTICS`` for every text."""
    words = words_of(column)
    n = len(column)
    size = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(n), size)
    kind = KIND[words.data]
    kinds = np.bincount(of * 10 + kind, minlength=n * 10).reshape(n, 10)
    text, count = words.text, np.diff(words.first)
    length = words.end - words.begin
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    per_word = np.maximum(count, 1)
    filled = np.maximum(size - kinds[:, WHITE] - kinds[:, FEED], 1)
    same = np.zeros(len(text), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    symbols = np.concatenate(([0], np.cumsum((kind == SYMBOL) | (kind == EXCLAMATION))))
    with_symbol = symbols[words.end] > symbols[words.begin]
    share = lambda marks: np.bincount(text[marks], minlength=n) / per_word
    distinct, most = _distinct(text, words.hashes, n)
    runs = []
    for k in (3, 2):
        at = words.windows(k)
        found = _distinct(text[at], words.sequence_hashes(k)[at], n)[0] if len(at) else np.zeros(n)
        runs.append(np.where(count >= k, found / np.maximum(count - k + 1, 1), 0))
    out = np.column_stack(
        [
            np.log1p(count), np.log1p(size), np.bincount(text, length, n) / per_word, longest,
            kinds[:, UPPER] / filled, kinds[:, LOWER] / filled, kinds[:, DIGIT] / filled,
            kinds[:, EXCLAMATION] / filled, kinds[:, STOP] / filled, kinds[:, SYMBOL] / filled,
            kinds[:, OTHER] / filled, kinds[:, HIGH] / filled, kinds[:, FEED] / per_word,
            share(length <= 3), distinct / per_word, share(same), most / per_word, runs[0], runs[1],
            share(kind[words.begin] == UPPER) if len(text) else np.zeros(n), share(with_symbol),
        ]
    )
    return out


@dataclass(frozen=True)
class Trees:
    """Boosted trees in heap order: node k has the children 2k+1 and 2k+2."""

    prior: float
    statistic: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.statistic.shape
        node = np.zeros((len(rows), trees), np.int64)
        which, at = np.arange(trees), np.arange(len(rows))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            high = rows[at, self.statistic[which, node]] > self.threshold[which, node]
            node = 2 * node + 1 + high
        total = self.prior + self.leaf[which, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, good: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 5.0,
) -> Trees:
    """Boosted trees for the log odds of ``good``."""
    share = (good.sum() + 1) / (len(good) + 2)
    prior = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    statistic = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if not len(good) or good.min() == good.max():
        return Trees(prior, statistic, threshold, leaf)
    edges = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) for x in rows.T]
    binned = np.column_stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, rows.T, strict=True)])
    total = np.full(len(rows), prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = good - p, p * (1 - p)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.zeros(width)
            for s, cut in enumerate(edges):
                if not len(cut):
                    continue
                key = local * (len(cut) + 1) + binned[:, s]
                g, h = (
                    np.bincount(key, x, width * (len(cut) + 1)).reshape(width, -1).cumsum(axis=1)
                    for x in (gradient, weight)
                )
                left_g, left_h = g[:, :-1], h[:, :-1]
                right_g, right_h = g[:, -1:] - left_g, h[:, -1:] - left_h
                gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge)
                gain -= g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                at = gain.argmax(axis=1)
                value = gain[np.arange(width), at]
                better = value > best + 1e-9
                best[better] = value[better]
                statistic[t, first : first + width][better] = s
                threshold[t, first : first + width][better] = cut[at[better]]
            high = rows[np.arange(len(rows)), statistic[t, node]] > threshold[t, node]
            node = 2 * node + 1 + high
        g = np.bincount(node - inner, gradient, inner + 1)
        h = np.bincount(node - inner, weight, inner + 1)
        leaf[t] = rate * g / (h + ridge)
        total += leaf[t][node - inner]
    return Trees(prior, statistic, threshold, leaf)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.cumsum(pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = int(size[start - 1]) if start else 0
            stop = int(np.searchsorted(size, done + BYTES_AT_ONCE, side="right"))
            stop = min(max(stop, start + 1), start + ROWS_AT_ONCE, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its statistics, written once."""
    rows = docs.select("doc_id", "text")
    fields = [rows.schema["doc_id"], *(T.StructField(name, T.DoubleType()) for name in STATISTICS)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            columns = statistics(batch.column(1)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in columns)], ["doc_id", *STATISTICS]
            )

    return staged(rows.mapInArrow(measure, T.StructType(fields)), "document-statistics")


def quality_scores(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 50_000, threshold: float = 0.3
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``."""
    measured = document_statistics(docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    lesson = (
        measured.join(known.filter(~held_out), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
        .select(F.col("quality").cast("double").alias("quality"), *STATISTICS)
        .toArrow()
    )
    table = np.column_stack([lesson[c].to_numpy() for c in ("quality", *STATISTICS)])
    # Rows of equal sums whatever order the rows came in.
    table = table[np.lexsort(table.T)]
    model = fit(table[:, 1:], table[:, 0])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns[1:]])
            scores = [model.score(rows[i : i + 4096]) for i in range(0, len(rows), 4096)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], ["doc_id", "score"]
            )

    fields = [measured.schema["doc_id"], T.StructField("score", T.DoubleType())]
    scored = measured.select("doc_id", *STATISTICS).mapInArrow(score, T.StructType(fields))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
