"""Language-model scores by Katz backoff, over n-gram tables partitioned by context.

A text's tokens are its words, A-Z as a-z, and one end.  With r* the Good-Turing count, n-grams
seen up to ``DISCOUNTED`` times lose the share 1 - d(r) of their count, in Katz's form, which
leaves frequent n-grams as they are.  What the followers of a context lose goes to the words
not seen after it, in proportion to the model of one order less:

    P(w | c) = d(r) r / n(c)                    if c w was seen r > 0 times
             = a(c) P(w | c without its first)  otherwise

a(c) is the mass left over, divided by what the seen followers do not take of the lower model,
so probabilities sum to 1 exactly, over the words known and one more that stands for all others.
Texts begin in a context of their own.

*Tables.*  Each task folds its documents into blocks: distinct words as 64-bit hashes, and the
texts as places in that list.  For each order a block sends its distinct n-grams with their
counts in training texts to the bucket of their context.  A bucket adds them up, which makes it
a partition of the n-gram table: context, word, count.  Counts of counts, a few numbers for each
bucket, are summed to the discounts.  Then the bucket works out the backoff weights of its
contexts and answers every block: count of the n-gram, total and weight of its context, and a
number for the n-gram, by which the next order names it as a context.  So a block knows
the probability of each of its n-grams, order after order, and looks none up twice.

*Size.*  All that is moved are distinct n-grams of some 30 MB of text, as packed whole numbers.
Buckets hold some ``BUCKET_BYTES`` of input each.  A context that was seen more than ``SPLIT``
times is split over buckets by the following word; only its sums are brought together.
Blocks are cut from the input in its order, which files give again if a task runs again.

Defined results: a null or empty text is one end; a row without an id is learned from and not
held out; repeated rows count as often as they are there; without training texts every
token is unknown, and all scores are 0; where counts of counts give no discounts between 0 and
1, half an occurrence is taken from each n-gram seen up to ``DISCOUNTED`` times; a context whose
followers lose nothing is counted as one occurrence larger; an empty table gives an empty one;
other columns are not read.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import bucket_count, slices
from palimpsest.llm.planes import bucket_of, packed, packed_floats, runs, unpacked, unpacked_floats
from palimpsest.llm.words import U64, mix, words_of

DISCOUNTED = 5
HALF = 0.5
SPLIT = 1 << 20
BLOCK_WORDS = 4 << 20
BUCKET_BYTES = 16 << 20
GOLDEN = U64(0x9E3779B97F4A7C15)
END = U64(0)  # hash of the end of a text

BLOCKS = "block long, docs binary, vocabulary binary, words binary"
SENT = "bucket int, block long, context binary, run binary, parts binary, word binary, count binary, lower binary"
SUMS = "bucket int, context long, seen array<long>, total long, kinds long, ends long, lower double"
TABLE = "context long, word long, count long, probability double, backoff double"
REPLIES = "block long, step int, bucket int, count binary, id binary, total binary, backoff binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
        "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


SENT_ARROW, SUMS_ARROW, REPLIES_ARROW, TABLE_ARROW = map(_schema, (SENT, SUMS, REPLIES, TABLE))


def discounts(seen: np.ndarray) -> np.ndarray:
    """d(0) to d(``DISCOUNTED``) from the numbers of n-grams seen once, twice, ..."""
    out = np.ones(DISCOUNTED + 1)
    out[0] = 0.0
    for most in range(DISCOUNTED, 1, -1):
        n, r = seen[: most + 1].astype(float), np.arange(1, most + 1)
        if (n[:-1] > 0).all():
            common = (most + 1) * n[most] / n[0]
            if common < 1:
                d = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
                if ((d > 0) & (d < 1)).all():
                    out[1 : most + 1] = d
                    return out
    r = np.arange(1, DISCOUNTED + 1)
    out[1:] = (r - HALF) / r
    return out


def kept(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts after discounting."""
    return count * np.where(count <= DISCOUNTED, d[np.minimum(count, DISCOUNTED)], 1.0)


def freed(seen: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What the n-grams of a context lose, from how many of them were seen once, twice, ..."""
    r = np.arange(1, DISCOUNTED + 1)
    return (seen[..., :DISCOUNTED] * (r * (1 - d[1:]))).sum(axis=-1)


# -- blocks of documents ---------------------------------------------------------------


def blocks(docs: DataFrame) -> DataFrame:
    """Documents (``doc_id``, ``learn``, ``text``) as blocks of words, in the order of the input."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, hashes, words = TaskContext.get().partitionId() << 32, [], [], 0

        def block() -> pa.RecordBatch:
            vocabulary, first, at, count = np.unique(
                np.concatenate(hashes), return_index=True, return_inverse=True, return_counts=True
            )
            order = np.argsort(-count, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for batch in rows:
                    out.write_batch(batch)
            columns = [
                pa.array([number], pa.int64()),
                pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.array([vocabulary[order].tobytes()], pa.binary()),
                pa.array([packed(place[at])], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["block", "docs", "vocabulary", "words"])

        for batch in slices(batches, "text"):
            found = words_of(batch.column(2), lower=True)
            sizes = np.diff(found.first)
            ends = np.insert(found.hashes, found.first[1:], END)
            tokens = pa.array(sizes + 1, pa.int64())
            rows.append(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], ["doc_id", "learn", "tokens"]))
            hashes.append(ends)
            words += len(ends)
            if words >= BLOCK_WORDS:
                yield block()
                number, rows, hashes, words = number + 1, [], [], 0
        if rows:
            yield block()

    return docs.select("doc_id", "learn", "text").mapInArrow(fold, BLOCKS)


class Block:
    """What a block knows: its n-grams of one order, and what buckets answered about them."""

    def __init__(self, row: pa.Table, buckets: int):
        with pa.ipc.open_stream(row["docs"][0].as_buffer()) as reader:
            self.docs = reader.read_all()
        self.number, self.buckets = row["block"][0].as_py(), buckets
        self.hashes = np.frombuffer(row["vocabulary"][0].as_py(), U64)
        self.words = unpacked(row["words"][0].as_py())
        sizes = self.docs["tokens"].to_numpy()
        self.first = np.cumsum(sizes) - sizes
        self.learn = np.repeat(self.docs["learn"].to_numpy(zero_copy_only=False), sizes)
        # Of the present order: the n-gram at each token, and of each n-gram its training count.
        self.order, self.gram = 1, self.words
        self.bucket = bucket_of(self.hashes, buckets)
        self._sort(np.lexsort((self.hashes, self.bucket)))

    def _sort(self, order: np.ndarray) -> None:
        self.here = np.bincount(self.gram[self.learn], minlength=len(order))
        self.sorted = order
        edges = np.searchsorted(self.bucket[order], np.arange(self.buckets + 1))
        self.edges = {int(k): (int(edges[k]), int(edges[k + 1])) for k in np.flatnonzero(np.diff(edges))}

    def send(self) -> pa.Table:
        rows = []
        for bucket, (a, b) in self.edges.items():
            at = self.sorted[a:b]
            row = {"bucket": bucket, "block": self.number, "count": packed(self.here[at])}
            if self.order == 1:
                row["word"] = self.hashes[at].tobytes()
            else:
                start = runs(self.context[at])
                row["context"] = packed(self.context_id[at[start]])
                row["run"] = packed(np.diff(np.append(start, len(at))))
                row["parts"] = packed(self.parts[at[start]])
                row["word"] = packed(self.word_id[at])
                row["lower"] = packed_floats(self.lower[at])
            rows.append(row)
        return pa.Table.from_pylist(rows, SENT_ARROW)

    def hear(self, replies: pa.Table, facts: np.ndarray) -> None:
        """Take the answers for the present order."""
        d, n = discounts(facts), len(self.sorted)
        count, ids = np.zeros(n, np.int64), np.zeros(n, np.int64)
        total, backoff = np.zeros(n, np.int64), np.ones(n)
        for row in replies.to_pylist():
            if row["step"] != self.order:
                continue
            a, b = self.edges[row["bucket"]]
            at = self.sorted[a:b]
            count[at] = unpacked(row["count"])
            if row["id"] is not None:
                ids[at] = unpacked(row["id"])
            if self.order > 1:
                size = np.diff(np.append(runs(self.context[at]), len(at)))
                total[at] = np.repeat(unpacked(row["total"]), size)
                backoff[at] = np.repeat(unpacked_floats(row["backoff"]), size)
        if self.order == 1:
            self.known, self.word_ids, self.texts = count, ids, int(facts[-1])
            total[:] = facts[DISCOUNTED + 1]
            lost = freed(facts, d)
            total += lost == 0
            self.prob = np.where(count > 0, kept(count, d) / np.maximum(total, 1), (lost or 1.0) / np.maximum(total, 1))
        else:
            self.prob = np.where(count > 0, kept(count, d) / np.maximum(total, 1), backoff * self.lower)
        self.count, self.ids = count, ids

    def climb(self) -> None:
        """Go on to n-grams of one word more: a context is the n-gram before, or a text's begin."""
        before = np.empty_like(self.gram)
        before[1:] = self.gram[:-1]
        before[self.first] = len(self.count)
        size = len(self.hashes)
        grams, at, gram = np.unique(before * size + self.words, return_index=True, return_inverse=True)
        self.lower = self.prob[self.gram[at]]
        self.context = grams // size
        self.word_id = self.word_ids[grams % size]
        self.context_id = np.append(self.ids + 1, 0)[self.context]
        self.parts = 1 + np.append(self.count, self.texts)[self.context] // SPLIT
        self.order, self.gram = self.order + 1, gram
        salt = mix(self.word_id.astype(U64)) % self.parts.astype(U64)
        self.bucket = bucket_of(mix(self.context_id.astype(U64) * GOLDEN + salt), self.buckets)
        self._sort(np.argsort(self.bucket, kind="stable"))

    def scores(self, facts: np.ndarray) -> pa.Table:
        total, kinds = facts[DISCOUNTED + 1 : DISCOUNTED + 3].astype(float)
        base = np.log10((self.known + HALF) / (total + HALF * (kinds + 1)))
        logs = np.log10(self.prob)
        known = (self.known > 0).astype(np.int64)

        def sums(values):
            return pa.array(np.add.reduceat(values, self.first) if len(self.first) else values)

        columns = {
            "doc_id": self.docs["doc_id"],
            "held_out": pa.array(~self.docs["learn"].to_numpy(zero_copy_only=False)),
            "n_tokens": self.docs["tokens"],
            "n_known": sums(known[self.words]),
            "train_tokens": pa.array(np.full(len(self.first), int(total), np.int64)),
            "base_score": sums(base[self.words]),
            "score": sums(logs[self.gram]),
        }
        return pa.table(columns)


# -- buckets: partitions of the n-gram tables ------------------------------------------


class Bucket:
    """A partition of the table of one order: distinct n-grams by context, with their counts."""

    def __init__(self, rows: pa.Table, order: int):
        self.rows = rows.select(SENT_ARROW.names).to_pylist()
        self.order = order
        counts = [unpacked(row["count"]) for row in self.rows]
        self.sizes = np.array([len(c) for c in counts])
        if order == 1:
            key = np.concatenate([np.frombuffer(row["word"], U64) for row in self.rows])
        else:
            self.run = [unpacked(row["run"]) for row in self.rows]
            context = np.concatenate([unpacked(row["context"]) for row in self.rows])
            run = np.concatenate(self.run)
            self.contexts, self.of_run = np.unique(context, return_inverse=True)
            of = np.repeat(self.of_run, run)
            words, word = np.unique(np.concatenate([unpacked(row["word"]) for row in self.rows]), return_inverse=True)
            # Places in lists of distinct values: their product is far below 2^63.
            key = of * len(words) + word
        grams, first, self.at = np.unique(key, return_index=True, return_inverse=True)
        self.count = np.bincount(self.at, np.concatenate(counts), len(grams)).astype(np.int64)
        if order == 1:
            self.ends = int(self.count[grams == END].sum())
        else:
            self.ends = 0
            lower = np.concatenate([unpacked_floats(row["lower"]) for row in self.rows])[first]
            parts = np.concatenate([unpacked(row["parts"]) for row in self.rows])
            self.parts = np.zeros(len(self.contexts), np.int64)
            self.parts[self.of_run] = parts
            self.context, self.word = grams // len(words), words[grams % len(words)]
            n, seen = len(self.contexts), self.count > 0
            self.total = np.bincount(self.context, self.count, n).astype(np.int64)
            self.lower = np.bincount(self.context[seen], lower[seen], n)
            self.seen = np.stack([np.bincount(self.context[self.count == r], minlength=n) for r in range(1, DISCOUNTED + 1)], 1)

    def sums(self, bucket: int) -> pa.Table:
        """Counts of counts, and of contexts that are split over buckets all that is summed."""
        seen = [int((self.count == r).sum()) for r in range(1, DISCOUNTED + 2)]
        rows = [
            {
                "bucket": bucket, "context": None, "seen": seen, "total": int(self.count.sum()),
                "kinds": int((self.count > 0).sum()), "ends": self.ends, "lower": 0.0,
            }
        ]
        if self.order > 1:
            for i in np.flatnonzero(self.parts > 1).tolist():
                rows.append(
                    {
                        "bucket": bucket, "context": int(self.contexts[i]), "seen": [*self.seen[i].tolist(), 0],
                        "total": int(self.total[i]), "kinds": 0, "ends": 0, "lower": float(self.lower[i]),
                    }
                )
        return pa.Table.from_pylist(rows, SUMS_ARROW)

    def join_split(self, split: pa.Table) -> None:
        """Put the sums over all buckets in place of the own ones."""
        if split.num_rows:
            at = np.searchsorted(self.contexts, split["context"].to_numpy())
            self.total[at], self.lower[at] = split["total"].to_numpy(), split["lower"].to_numpy()
            self.seen[at] = np.array(split["seen"].to_pylist())[:, :DISCOUNTED]

    def weigh(self, facts: np.ndarray) -> None:
        """Totals by which counts are divided, and backoff weights."""
        self.d = discounts(facts)
        lost = freed(self.seen, self.d)
        used = self.total > 0
        self.total += used & (lost == 0)
        lost = np.where(lost == 0, 1.0, lost)
        left = lost / np.maximum(self.total, 1) / np.maximum(1.0 - self.lower, np.finfo(float).tiny)
        self.backoff = np.where(used, left, 1.0)

    def numbers(self, bucket: int, buckets: int) -> np.ndarray:
        """A number for each n-gram, small for frequent ones."""
        place = np.empty(len(self.count), np.int64)
        place[np.argsort(-self.count, kind="stable")] = np.arange(len(self.count))
        return place * buckets + bucket

    def replies(self, bucket: int, buckets: int, last: bool) -> pa.Table:
        count = self.count[self.at]
        ids = None if last else self.numbers(bucket, buckets)[self.at]
        out, start, start_run = [], 0, 0
        for i, row in enumerate(self.rows):
            stop = start + int(self.sizes[i])
            reply = {"block": row["block"], "step": self.order, "bucket": bucket, "count": packed(count[start:stop])}
            if ids is not None:
                reply["id"] = packed(ids[start:stop])
            if self.order > 1:
                stop_run = start_run + len(self.run[i])
                at = self.of_run[start_run:stop_run]
                # A weight is only asked for where some word was not seen after the context.
                missing = np.add.reduceat(count[start:stop] == 0, np.cumsum(self.run[i]) - self.run[i]) > 0
                reply["total"] = packed(self.total[at])
                reply["backoff"] = packed_floats(np.where(missing, self.backoff[at], 1.0))
                start_run = stop_run
            out.append(reply)
            start = stop
        return pa.Table.from_pylist(out, REPLIES_ARROW)

    def table(self) -> pa.Table:
        probability = kept(self.count, self.d) / np.maximum(self.total[self.context], 1)
        seen = self.count > 0
        columns = [
            self.contexts[self.context], self.word, self.count, probability, self.backoff[self.context],
        ]
        return pa.Table.from_arrays([pa.array(c[seen]) for c in columns], schema=TABLE_ARROW)


def _adding(order: int):
    return lambda key, rows: Bucket(rows, order).sums(key[0].as_py())


def _naming(buckets: int):
    return lambda key, rows: Bucket(rows, 1).replies(key[0].as_py(), buckets, last=False)


def _weighed(rows: pa.Table, split: pa.Table, order: int) -> Bucket:
    bucket = Bucket(rows, order)
    bucket.join_split(split)
    bucket.weigh(_of(rows, "facts"))
    return bucket


def _answering(order: int, buckets: int, last: bool):
    def answer(key, rows, split):
        if not rows.num_rows:
            return REPLIES_ARROW.empty_table()
        return _weighed(rows, split, order).replies(key[0].as_py(), buckets, last)

    return answer


def _listing(order: int):
    return lambda rows, split: _weighed(rows, split, order).table() if rows.num_rows else TABLE_ARROW.empty_table()


def _facts(sums: DataFrame) -> Column:
    """Counts of counts, tokens, distinct n-grams and texts, over all buckets."""
    seen = [F.sum(F.col("seen")[i]) for i in range(DISCOUNTED + 1)]
    whole = [F.sum("total"), F.sum("kinds"), F.sum("ends")]
    values = F.array(*(F.coalesce(x, F.lit(0)) for x in (*seen, *whole)))
    return sums.filter("context IS NULL").agg(values.alias("facts")).scalar()


def _split(sums: DataFrame) -> DataFrame:
    """The sums of contexts that are split, in every bucket that has a part."""
    seen = [F.sum(F.col("seen")[i]) for i in range(DISCOUNTED + 1)]
    whole = sums.filter("context IS NOT NULL").groupBy("context").agg(
        F.array(*seen).alias("seen"), F.sum("total").alias("total"), F.sum("lower").alias("lower"),
        F.collect_set("bucket").alias("buckets"),
    )
    return whole.select(F.explode("buckets").alias("bucket"), "context", "seen", "total", "lower")


def _of(table: pa.Table, name: str) -> np.ndarray:
    return np.array(table[name][0].as_py())


class Model:
    """The exchange of all orders; nothing runs before its rows are asked for."""

    def __init__(self, docs: DataFrame, order: int):
        # As many tasks as buckets: both grow with the input.
        buckets = bucket_count(docs.select("text"), BUCKET_BYTES)
        self.texts = blocks(docs).repartition(buckets, "block")
        self.facts: list[Column] = []
        self.replies: DataFrame | None = None
        self.tables: list[DataFrame] = []

        for step in range(1, order + 1):
            sent = self._sent(step, buckets)
            sums = sent.groupBy("bucket").applyInArrow(_adding(step), SUMS)
            self.facts.append(_facts(sums))
            if step == 1:
                answers = sent.groupBy("bucket").applyInArrow(_naming(buckets), REPLIES)
            else:
                known = sent.withColumn("facts", self.facts[-1]).groupBy("bucket")
                known = known.cogroup(_split(sums).groupBy("bucket"))
                answers = known.applyInArrow(_answering(step, buckets, step == order), REPLIES)
                self.tables.append(known.applyInArrow(_listing(step), TABLE))
            self.replies = answers if self.replies is None else self.replies.unionByName(answers)
        self.buckets = buckets

    def _known(self):
        """Blocks with the facts of the orders so far, next to the answers so far."""
        named = {f"facts{i}": column for i, column in enumerate(self.facts)}
        return self.texts.withColumns(named).groupBy("block").cogroup(self.replies.groupBy("block"))

    def _sent(self, step: int, buckets: int) -> DataFrame:
        if step == 1:

            def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        yield from Block(pa.Table.from_batches([batch.slice(i, 1)]), buckets).send().to_batches()

            return self.texts.mapInArrow(send_words, SENT)

        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return SENT_ARROW.empty_table()
            return _heard(left, right, buckets, step - 1).send()

        return self._known().applyInArrow(send, SENT)


def _heard(left: pa.Table, right: pa.Table, buckets: int, steps: int) -> Block:
    """A block that took the answers of so many orders and has the n-grams of the next."""
    block = Block(left, buckets)
    for step in range(steps):
        block.hear(right, _of(left, f"facts{step}"))
        block.climb()
    return block


def _learning(docs: DataFrame, learn: Column) -> DataFrame:
    return docs.select("doc_id", F.coalesce(learn, F.lit(True)).alias("learn"), "text")


def katz_scores(docs: DataFrame, learn: Column, order: int = 2) -> DataFrame:
    """Counts and log10 probabilities of every text; the model learns from rows with ``learn``."""
    if order < 1:
        raise ValueError("an order of 1 at least")
    rows = _learning(docs, learn)
    model = Model(rows, order)
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    buckets, names = model.buckets, schema.names

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _heard(left, right, buckets, order - 1)
        block.hear(right, _of(left, f"facts{order - 1}"))
        return block.scores(_of(left, "facts0")).select(names)

    return model._known().applyInArrow(finish, schema)


def katz_table(docs: DataFrame, learn: Column, order: int = 2) -> DataFrame:
    """The n-grams of the highest order seen: count, probability, and backoff of their context."""
    return Model(_learning(docs, learn), order).tables[-1]
