"""Phrases that hold together, from weighted acyclic automata of n-gram counts.

Texts are cut into pieces at marks and line ends, and pieces into words.  A phrase is scored by
its weakest cut: with a its count and l, r those of the two parts, a^2 / (l r) in millionths.
A phrase is dropped if a longer one that holds it is at least half as frequent.

*Count transducers.*  A path of an automaton is a language and up to ``longest`` words, and its
weight the number of times they occur.  Each task sorts the n-grams of some 10 MB of text, word by
word: the states of a depth are the distinct pairs of a state before and a word, in order, so
each depth is built from the one above.  States are kept apart where counts are, so
only ends are shared.

*Union.*  A shard cuts its automaton by prefix: paths go to the bucket of their language and first
word.  A prefix that a sample shows to be frequent is cut once more, by its next word, and so
on, so a word that begins a third of all phrases is spread; how paths are dealt out changes no
count.  A bucket makes the union of its parts, sums weights, and keeps the states of
``least`` occurrences and more: parts of a phrase are never rarer than the phrase.  The automata
are written once to the shared folder, a row for each bucket.

*Composition.*  The parts of all candidates, each once, are dealt to the buckets by the same rule,
and run through the bucket's automaton, which gives their weights.  Scores are whole
numbers of up to 38 digits.  The rest are joins on phrases and a window that keeps the first
rows of each language in every task before the shuffle.

Defined results: a null or empty text has no words; a null language is ``und``; ids are not read,
so repeated rows and rows without an id count; ties are ordered as stated in
``collocations``; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.batches import bucket_count, input_bytes, slices
from palimpsest.llm.planes import bucket_of, packed, runs, unpacked
from palimpsest.llm.words import U64, mix, words_of
from palimpsest.session import staged

BETWEEN = np.zeros(256, bool)
BETWEEN[[*b" \t.,;:!?", *range(0x0A, 0x0E)]] = True
MARKS = BETWEEN.copy()
MARKS[[*b" \t"]] = False

SHARD_WORDS = 3 << 19
BUCKET_BYTES = 4 << 20
SAMPLE_BYTES = 16 << 20  # of text, to find frequent prefixes
SAMPLE_LEAST = 50
GOLDEN = U64(0x9E3779B97F4A7C15)
PARTS = "bucket int, part binary"
AUTOMATA = "bucket int, automaton binary, langs array<string>, totals array<long>"


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()], U64)


def _add(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a path with one word more."""
    return mix(prefix * GOLDEN + word)


class Automaton:
    """States by depth: the state before, the word (a place in ``words``), and the weight.

    The states of a depth are sorted by state before and word; the first depth are languages.
    """

    def __init__(self, words: pa.Array, depths: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.words, self.depths = words, depths

    @classmethod
    def build(cls, words: pa.Array, paths: list[tuple[np.ndarray, np.ndarray]], longest: int) -> Automaton:
        """From paths, sorted or not: for each length the words, one row for each, and weights."""
        n, depths = len(words), []
        at = [np.zeros(len(weight), np.int64) for _, weight in paths]
        for depth in range(longest):
            deep = [i for i, (labels, _) in enumerate(paths) if len(labels) > depth]
            keys = [at[i] * n + paths[i][0][depth] for i in deep]
            states, place = _distinct(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            weight, start = np.zeros(len(states), np.int64), 0
            for i, key in zip(deep, keys, strict=True):
                at[i] = place[start : start + len(key)]
                start += len(key)
                if len(paths[i][0]) == depth + 1:
                    weight += np.bincount(at[i], paths[i][1], len(states)).astype(np.int64)
            depths.append((states // max(n, 1), states % max(n, 1), weight))
        return cls(words, depths)

    def paths(self, depth: int) -> np.ndarray:
        """The words of all states of a depth, one row for each place."""
        rows, state = [], np.arange(len(self.depths[depth][0]))
        for before, label, _ in reversed(self.depths[: depth + 1]):
            rows.append(label[state])
            state = before[state]
        return np.array(rows[::-1])

    def frequent(self, least: int) -> Automaton:
        """Without the states of less weight that lead to no other."""
        stay, keep = None, []
        for depth in reversed(range(len(self.depths))):
            before, label, weight = self.depths[depth]
            held = weight >= least
            if stay is not None:
                held[self.depths[depth + 1][0][stay]] = True
            keep.append(held)
            stay = held
        keep = keep[::-1]
        used = np.zeros(len(self.words), bool)
        for held, (_, label, _) in zip(keep, self.depths, strict=True):
            used[label[held]] = True
        place, depths = np.cumsum(used) - 1, []
        number = np.zeros(1, np.int64)
        for held, (before, label, weight) in zip(keep, self.depths, strict=True):
            depths.append((number[before[held]], place[label[held]], weight[held]))
            number = np.cumsum(held) - 1
        return Automaton(self.words.filter(pa.array(used)), depths)

    def weights(self, paths: pa.Array, longest: int) -> np.ndarray:
        """The weights of paths given as lists of words; 0 for those that the automaton lacks."""
        sizes = pc.list_value_length(paths).to_numpy(zero_copy_only=False)
        flat = pc.index_in(pc.list_flatten(paths), value_set=self.words).fill_null(-1).to_numpy()
        first = np.cumsum(sizes) - sizes
        state, weight = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        alive = np.arange(len(sizes))
        for depth in range(min(longest, len(self.depths))):
            before, label, found = self.depths[depth]
            alive = alive[sizes[alive] > depth]
            keys, wanted = before * max(len(self.words), 1) + label, flat[first[alive] + depth]
            key = state[alive] * max(len(self.words), 1) + wanted
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = (wanted >= 0) & (keys[at] == key) if len(keys) else np.zeros(len(alive), bool)
            alive, at = alive[hit], at[hit]
            state[alive] = at
            end = sizes[alive] == depth + 1
            weight[alive[end]] = found[at[end]]
        return weight

    def written(self) -> bytes:
        return _join([*_texts(self.words), *(packed(x) for depth in self.depths for x in depth)])

    @classmethod
    def read(cls, raw: bytes) -> Automaton:
        sizes, texts, *numbers = _split(raw)
        numbers = [unpacked(x) for x in numbers]
        depths = [tuple(numbers[i : i + 3]) for i in range(0, len(numbers), 3)]
        return cls(_words(sizes, texts), depths)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the place of each key; keys come in runs, which are sorted once."""
    start = runs(keys) if len(keys) else np.zeros(0, np.int64)
    found, place = np.unique(keys[start], return_inverse=True)
    return found, np.repeat(place, np.diff(np.append(start, len(keys))))


def _join(parts: list[bytes]) -> bytes:
    sizes = np.array([len(parts), *map(len, parts)], np.int64)
    return b"".join((sizes.tobytes(), *parts))


def _split(raw: bytes) -> list[bytes]:
    n = int.from_bytes(raw[:8], "little")
    ends = 8 * (n + 1) + np.concatenate(([0], np.cumsum(np.frombuffer(raw[8 : 8 * (n + 1)], np.int64))))
    return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _texts(words: pa.Array) -> tuple[bytes, bytes]:
    """Sizes of strings and, compressed, their bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    data = data[int(offsets[0]) : int(offsets[-1])] if data is not None else b""
    return packed(np.diff(offsets)), pa.compress(data, codec="zstd", asbytes=True)


def _words(sizes: bytes, texts: bytes) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(unpacked(sizes))))
    data = pa.decompress(texts, int(offsets[-1]), codec="zstd")
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data)


class Cells:
    """Which bucket a path belongs to: that of its shortest prefix that is not frequent."""

    def __init__(self, buckets: int, frequent: np.ndarray):
        self.buckets, self.frequent = buckets, np.sort(frequent)

    def of(self, prefixes: list[np.ndarray]) -> np.ndarray:
        """``prefixes`` are hashes of the paths' first words, first two, and so on."""
        cell = prefixes[0].copy()
        open_ = np.ones(len(cell), bool)
        for shorter, longer in zip(prefixes, prefixes[1:], strict=False):
            open_ &= np.isin(shorter, self.frequent)
            cell[open_] = longer[open_]
        return bucket_of(cell, self.buckets)


class Shard:
    """The words of many texts, and the automaton of their n-grams."""

    def __init__(self, longest: int):
        self.longest, self.size = longest, 0
        self.raw, self.lengths, self.pieces, self.langs = [], [], [], []
        self.names: dict[str, int] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        """Texts in the second column, languages in the first."""
        found = words_of(batch.column(1), BETWEEN, lower=True)
        if not len(found.begin):
            return
        names = batch.column(0).to_pylist()
        lang = np.array([self.names.setdefault(x, len(self.names)) for x in names], np.int64)
        # A piece ends at a mark, and with its text.
        marks = np.cumsum(MARKS[found.data])
        piece = marks[found.begin] + found.text + (self.pieces[-1][-1] + 1 if self.pieces else 0)
        self.raw.append(found.data[~BETWEEN[found.data]])
        self.lengths.append(found.end - found.begin)
        self.pieces.append(piece)
        self.langs.append(lang[found.text])
        self.size += len(found.begin)

    def counts(self) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
        """Words, sorted, and languages; for each length the distinct paths, sorted, and weights."""
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(self.lengths))))
        data = pa.py_buffer(np.concatenate(self.raw))
        texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data)
        coded = texts.dictionary_encode()
        by_bytes = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(by_bytes), np.int32)
        place[by_bytes] = np.arange(len(by_bytes))
        names = pa.array(list(self.names), pa.large_string())
        words = pa.concat_arrays([coded.dictionary.take(pa.array(by_bytes)), names])
        word, piece = place[coded.indices.to_numpy()], np.concatenate(self.pieces)
        n, state = len(words), np.concatenate(self.langs) + len(coded.dictionary)
        labels, out = np.arange(n, dtype=np.int32)[None, :], []
        # A state is a place in the list of distinct paths; languages are their own.
        for length in range(1, self.longest + 1):
            fits = len(word) - length + 1
            if fits <= 0:
                break
            here = np.flatnonzero((piece[: fits] == piece[length - 1 :]) & (state[:fits] >= 0))
            paths, at, weight = np.unique(
                state[here] * n + word[here + length - 1], return_inverse=True, return_counts=True
            )
            labels = np.concatenate((labels[:, paths // n], (paths % n).astype(np.int32)[None, :]))
            out.append((labels, weight))
            state = np.full(len(word), -1, np.int64)
            state[here] = at
        return words, out


def shards(docs: DataFrame, longest: int, work, schema: str) -> DataFrame:
    """``work`` on each shard of the documents (``lang``, ``text``), in their order."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(longest)
        for batch in slices(batches, "text"):
            shard.add(batch)
            if shard.size >= SHARD_WORDS:
                yield work(*shard.counts())
                shard = Shard(longest)
        if shard.size:
            yield work(*shard.counts())

    return docs.mapInArrow(fold, schema)


def _prefixes(hashes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Hashes of the language with the first word, the first two, ..., from those of the words."""
    state, out = hashes[labels[0]], []
    for row in labels[1:]:
        state = _add(state, hashes[row])
        out.append(state)
    return out


def frequent_prefixes(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Hashes of prefixes of which a sample has more than half a bucket's share.

    A sample of ``SAMPLE_BYTES`` of input, and so a bounded number of prefixes: fewer than
    ``2 * longest * buckets``, and than its words / ``SAMPLE_LEAST``.  It only bears on how evenly
    paths are dealt out.
    """
    if longest < 2:
        return np.zeros(0, U64)

    def count(words, paths):
        """Prefixes met more than once, and without a prefix the number of words."""
        hashes = _hashes(words)
        found = [(_prefixes(hashes, labels)[-1], weight) for labels, weight in paths[: longest - 1]]
        usual = [(key[weight > 1], weight[weight > 1]) for key, weight in found]
        key = pa.array(np.concatenate([k for k, _ in usual]).view(np.int64))
        every = int(paths[0][1].sum())
        n = np.concatenate([w for _, w in usual] + [[every]]).astype(np.int64)
        return pa.record_batch([pa.concat_arrays([key, pa.nulls(1, pa.int64())]), pa.array(n)], ["prefix", "n"])

    share = min(1.0, SAMPLE_BYTES / max(input_bytes(docs), 1))
    sample = docs.sample(share, seed=7) if share < 1 else docs
    found = shards(sample, longest - 1, count, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    found = staged(found.filter(F.col("n") >= SAMPLE_LEAST), "prefixes")
    words = found.filter("prefix IS NULL").first()
    if words is None:
        return np.zeros(0, U64)
    rows = found.filter("prefix IS NOT NULL").filter(F.col("n") * 2 * buckets > words.n).collect()
    return np.array([r.prefix for r in rows], np.int64).view(U64)


def count_automata(docs: DataFrame, longest: int, least: int, cells: Cells) -> DataFrame:
    """One row for each bucket: its automaton, and the words of each language that begin in it."""
    buckets = cells.buckets

    def cut(words: pa.Array, paths: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, dealt = _hashes(words), []
        for labels, _ in paths:
            bucket = cells.of(_prefixes(hashes, labels))
            order = np.argsort(bucket, kind="stable")
            dealt.append((order, np.searchsorted(bucket[order], np.arange(buckets + 1))))
        names, raw = [], []
        for k in range(buckets):
            here = [order[edges[k] : edges[k + 1]] for order, edges in dealt]
            part = [(labels[:, at], weight[at]) for at, (labels, weight) in zip(here, paths, strict=True) if len(at)]
            if part:
                names.append(k)
                raw.append(_part(words, part))
        return pa.record_batch([pa.array(names, pa.int32()), pa.array(raw, pa.binary())], ["bucket", "part"])

    def unite(key, rows):
        whole = _united([_split(raw.as_py()) for raw in rows["part"]], longest)
        totals: dict[int, int] = {}
        if len(whole.depths) > 1:
            before, _, weight = whole.depths[1]
            sums = np.bincount(before, weight, len(whole.depths[0][0])).astype(np.int64)
            totals = dict(zip(whole.words.take(whole.depths[0][1]).to_pylist(), sums.tolist(), strict=True))
        columns = [
            pa.array([key[0].as_py()], pa.int32()),
            pa.array([whole.frequent(least).written()], pa.binary()),
            pa.array([list(totals)], pa.list_(pa.string())),
            pa.array([list(totals.values())], pa.list_(pa.int64())),
        ]
        return pa.Table.from_arrays(columns, ["bucket", "automaton", "langs", "totals"])

    parts = shards(docs, longest, cut, PARTS)
    return parts.groupBy("bucket").applyInArrow(unite, AUTOMATA)


def _part(words: pa.Array, paths: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Sorted paths with the words they use, in the same order."""
    held = np.zeros(len(words), bool)
    for labels, _ in paths:
        held[labels] = True
    used = np.flatnonzero(held)
    place = np.cumsum(held, dtype=np.int32) - 1
    out = [*_texts(words.take(pa.array(used)))]
    for labels, weight in paths:
        labels = place[labels]
        out.append(_join([packed(row) for row in (*labels, weight)]))
    return _join(out)


def _united(parts: list[list[bytes]], longest: int) -> Automaton:
    """The union of automata given as words and sorted paths; weights of equal paths are summed."""
    coded = pa.chunked_array([_words(*part[:2]) for part in parts]).dictionary_encode().unify_dictionaries()
    words = coded.chunk(0).dictionary
    by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for part, names in zip(parts, coded.chunks, strict=True):
        place = names.indices.to_numpy().astype(np.int32)
        for raw in part[2:]:
            *numbers, weight = (unpacked(x) for x in _split(raw))
            labels = np.stack([place[x] for x in numbers])
            by_length.setdefault(len(labels), []).append((labels, weight))
    paths = []
    for length in sorted(by_length):
        found = by_length.pop(length)
        paths.append((np.concatenate([x for x, _ in found], axis=1), np.concatenate([w for _, w in found])))
    return Automaton.build(words, paths, longest + 1)


def candidates(automata: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang``, ``words`` and ``a`` of the phrases of two words and more."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                automaton = Automaton.read(raw.as_py())
                for depth in range(2, min(longest + 1, len(automaton.depths))):
                    weight = automaton.depths[depth][2]
                    at = np.flatnonzero(weight >= least)
                    labels = automaton.paths(depth)[:, at]
                    flat = automaton.words.take(pa.array(labels[1:].T.reshape(-1))).cast(pa.string())
                    offsets = pa.array(np.arange(len(at) + 1) * depth, pa.int32())
                    yield pa.record_batch(
                        [
                            automaton.words.take(pa.array(labels[0])).cast(pa.string()),
                            pa.ListArray.from_arrays(offsets, flat),
                            pa.array(weight[at]),
                        ],
                        ["lang", "words", "a"],
                    )

    return automata.select("automaton").mapInArrow(phrases, "lang string, words array<string>, a long")


def part_weights(automata: DataFrame, parts: DataFrame, cells: Cells, longest: int) -> DataFrame:
    """``lang``, ``part`` (its words joined by spaces) and ``f`` of each of ``parts``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = [[lang, *part.split(" ")] for lang, part in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            flat = pa.array([w for p in path for w in p], pa.large_string()).dictionary_encode()
            sizes = np.array([len(p) for p in path], np.int64)
            first, bucket = np.cumsum(sizes) - sizes, np.zeros(len(path), np.int64)
            index, hashes = flat.indices.to_numpy(), _hashes(flat.dictionary)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                labels = index[first[at] + np.arange(size)[:, None]]
                bucket[at] = cells.of(_prefixes(hashes, labels))
            yield pa.record_batch([pa.array(bucket.astype(np.int32)), *batch.columns], ["bucket", "lang", "part"])

    def compose(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows or not left.num_rows:
            return pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())]).empty_table()
        automaton = Automaton.read(left["automaton"][0].as_py())
        langs, parts = right["lang"].to_pylist(), right["part"].to_pylist()
        paths = pa.array([[x, *p.split(" ")] for x, p in zip(langs, parts, strict=True)], pa.list_(pa.large_string()))
        return pa.table({"lang": right["lang"], "part": right["part"], "f": automaton.weights(paths, longest + 1)})

    asked = parts.select("lang", "part").mapInArrow(deal, "bucket int, lang string, part string")
    by_bucket = automata.select("bucket", "automaton").groupBy("bucket")
    return by_bucket.cogroup(asked.groupBy("bucket")).applyInArrow(compose, "lang string, part string, f long")


def cut_score() -> Column:
    """floor(1000000 a^2 / (l r)) in whole numbers of up to 38 digits; a, l and r of up to 15."""
    square = "cast(a AS decimal(15, 0)) * cast(a AS decimal(15, 0)) * cast(1000000 AS decimal(7, 0))"
    return F.expr(f"({square}) div (cast(l AS decimal(15, 0)) * cast(r AS decimal(15, 0)))")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, first: int = 2000) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    ``first`` phrases of each language by score, then count, then bytes of the phrase.  Of cuts
    that score alike the one with the shorter first part counts.  ``n`` are the words of the
    language.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = bucket_count(rows, BUCKET_BYTES)
    cells = Cells(buckets, frequent_prefixes(rows, longest, buckets))
    automata = staged(count_automata(rows, longest, least, cells), "count-automata")

    found = staged(candidates(automata, longest, least), "phrases").withColumn("phrase", F.array_join("words", " "))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1))
    cuts = found.select("lang", "phrase", "a", "words", cut.alias("k"))
    joined = lambda begin, size: F.array_join(F.slice("words", begin, size), " ")
    cuts = cuts.withColumns({"first": joined(F.lit(1), F.col("k")), "rest": joined(F.col("k") + 1, F.size("words"))})
    parts = cuts.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct()
    weights = staged(part_weights(automata, parts, cells, longest), "part-weights")
    left = weights.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = weights.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cuts.drop("words").join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", cut_score())
    weakest = F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase").agg(weakest).select("lang", "phrase", "cut.*")

    # Phrases within longer ones, with the count of the most frequent of these.
    inner = found.filter(F.size("words") > 2).select("lang", "words", F.col("a").alias("longer"))
    size = F.explode(F.sequence(F.lit(2), F.size("words") - 1))
    inner = inner.select("lang", "words", "longer", size.alias("size"))
    begin = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    inner = inner.select("lang", "longer", "words", "size", begin.alias("begin"))
    inner = inner.select("lang", joined(F.col("begin"), F.col("size")).alias("phrase"), "longer")
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = F.coalesce(F.col("longer") * 100 >= F.col("a") * percent, F.lit(False))
    scored = scored.join(inner, ["lang", "phrase"], "left").filter(~held)

    totals = automata.select(F.explode(F.arrays_zip("langs", "totals")).alias("x"))
    totals = totals.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.totals").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
