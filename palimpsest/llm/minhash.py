"""Near-duplicate documents by BagMinHash signatures, banding and exact verification.

The bag of a document holds its shingles (``shingle`` consecutive words; a shorter document is
one shingle) with their counts; similarity is the weighted Jaccard index, the sum of minima
over the sum of maxima.

*Signature.*  The weight axis of a shingle is cut into dyadic intervals [0,1), [1,2), [2,4), ...
and each interval has a Poisson process of its own, seeded by shingle and interval, whose points
have an arrival time, a register and a position in the interval.  Those of the shingle's
intervals up to its count are walked through in order of time; in the last interval points
beyond the count do not count.  A register keeps its earliest point.  Two documents agree in a
register with a probability that equals their similarity.  Points later than a bound that
shrinks with the document's weight cannot matter once every register is filled, so the work is
one point per shingle and some for each register; if a register stayed empty, the document
is done again with a larger bound.

*Bands.*  Documents that agree in all ``rows`` registers of one of ``bands`` bands are
candidates: at similarity 0.8 and with 32 bands of 5 all but 3 in a million.

*Verification.*  Documents of equal words are one class.  Candidates are joined to candidate
groups (``components``), and all classes of a group are compared exactly by multiset overlap,
large groups in pairs of blocks (``pairs``), so no pair is missed within a group and no list of
pairs is written.  Verified links give the classes returned.

Defined results: a text without words links with nothing; a row without an id likewise, and its
class is null; every row is classed by its own text, also where an id has several, so repeated
rows get one class, and all of them are ``kept`` if one is; among equal texts the smallest id is
kept; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.components import components
from palimpsest.llm.pairs import bipartite_forest, block_pairs, forest
from palimpsest.llm.words import U64, Words, mix, words_of
from palimpsest.session import staged

BLOCK = 1024  # documents
BLOCK_SHINGLES = 1 << 20
ROWS_AT_ONCE = 256
BYTES_AT_ONCE = 2 << 20
COLUMNS_AT_ONCE = 4096
GOLDEN = U64(0x9E3779B97F4A7C15)
SEEDS = (U64(0x2545F4914F6CDD1D), U64(0xC2B2AE3D27D4EB4F))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The text that each shingle belongs to and the shingle's hash."""
    at = words.windows(size)
    text, value = words.text[at] if len(at) else at, words.sequence_hashes(size)[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < size))
    whole = np.zeros(len(short), U64)
    for k in range(size - 1):
        has = n[short] > k
        whole[has] = mix(whole[has] * GOLDEN + words.hashes[words.first[short[has]] + k] + U64(1))
    return np.concatenate((text, short)), np.concatenate((value, whole))


def bags(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts, in order of text."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    counts = np.diff(np.append(np.flatnonzero(new), len(text)))
    return text[new], value[new], counts


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """For each text the points that its registers keep; texts without shingles have zeros."""
    weight = np.bincount(text, count, texts)
    # One item for each dyadic interval that begins below the count.
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 1)
    of = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    begin = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.where(level > 0, begin, 1.0)
    seed = mix(value[of] + (level.astype(U64) + U64(1)) * GOLDEN)
    out = np.zeros((texts, registers), U64)
    bound = (np.log(registers) + 4) / np.maximum(weight, 1)
    todo = np.flatnonzero(weight > 0)
    while len(todo):
        # Few shingles need many points each, which are then drawn many at a time.
        light = weight[todo] < 64
        for some, step in ((todo[light], 64), (todo[~light], 2)):
            if len(some):
                chosen = np.isin(text[of], some) if len(some) < texts else np.ones(len(of), bool)
                _points(
                    out, text[of][chosen], seed[chosen], begin[chosen], length[chosen],
                    count[of][chosen], bound, registers, step,
                )
        empty = (out[todo] == 0).any(axis=1)
        todo = todo[empty]
        out[todo] = 0
        bound[todo] *= 2
    return out


def _points(out, text, seed, begin, length, count, bound, registers, step) -> None:
    earliest = np.full(out.size, np.inf)
    cells, times, points = [], [], []
    time, drawn = np.zeros(len(seed)), 0
    while len(seed):
        number = U64(2) * (np.arange(drawn + 1, drawn + step + 1, dtype=U64))
        gap = -np.log(_uniform(mix(seed[:, None] + number * GOLDEN)))
        at = time[:, None] + np.cumsum(gap / (registers * length)[:, None], axis=1)
        row, column = np.nonzero(at < bound[text][:, None])
        point = mix(seed[row] + (number[column] + U64(1)) * GOLDEN)
        register = (point >> U64(40)).astype(np.int64) % registers
        place = (point & U64((1 << 40) - 1)).astype(np.float64) * 2.0**-40
        inside = begin[row] + place * length[row] < count[row]
        cell = (text[row] * registers + register)[inside]
        when = at[row, column][inside]
        np.minimum.at(earliest, cell, when)
        cells.append(cell)
        times.append(when)
        points.append(point[inside])
        more = at[:, -1] < bound[text]
        time = at[more, -1]
        text, seed, begin, length, count = text[more], seed[more], begin[more], length[more], count[more]
        drawn += step
    cell, when, point = map(np.concatenate, (cells, times, points))
    kept = when == earliest[cell]
    out.reshape(-1)[cell[kept]] = point[kept] | U64(1)


def _pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text size."""
    for batch in batches:
        sizes = np.cumsum(pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = int(sizes[start - 1]) if start else 0
            stop = int(np.searchsorted(sizes, done + BYTES_AT_ONCE, side="right"))
            stop = min(max(stop, start + 1), start + ROWS_AT_ONCE, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def text_hashes(words: Words) -> list[np.ndarray]:
    """Two hashes of each text's words in their order."""
    place = np.arange(len(words.hashes)) - words.first[words.text].astype(np.int64)
    spread = [mix(words.hashes + mix(place.astype(U64) * GOLDEN + seed)) for seed in SEEDS]
    total = [np.concatenate((np.zeros(1, U64), np.cumsum(s, dtype=U64))) for s in spread]
    return [t[words.first[1:]] - t[words.first[:-1]] for t in total]


def band_table(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """For each row two hashes of its words, its number of shingles, and its band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 1):
            words = words_of(batch.column(1))
            text, value = shingles(words, shingle)
            n = np.bincount(text, minlength=batch.num_rows)
            points = signatures(*bags(text, value), batch.num_rows, bands * rows)
            keys = np.arange(1, bands + 1, dtype=U64) * np.ones((batch.num_rows, 1), U64)
            for k in range(rows):
                keys = mix(keys * GOLDEN + points[:, k::rows])
            has = n > 0
            whole = text_hashes(words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    _signed(whole[0]),
                    _signed(whole[1]),
                    pa.array(n.astype(np.int64)),
                    pa.array(
                        [row if h else None for row, h in zip(keys.view(np.int64), has, strict=True)],
                        pa.list_(pa.int64()),
                    ),
                ],
                ["doc_id", "h1", "h2", "n", "bands"],
            )

    columns = docs.select("doc_id", "text")
    return columns.mapInArrow(sign, "doc_id long, h1 long, h2 long, n long, bands array<long>")


def _bag_rows(rows: DataFrame, shingle: int) -> DataFrame:
    """In place of ``text`` the sorted hashes of its shingles, the repeats of one told apart.

    Rows whose text is not that of the class are left out, and repeated rows of a task but one.
    """

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in _pieces(batches, 2):
            words = words_of(batch.column(2))
            wanted = [x.to_pylist() for x in batch.column(0).flatten()]
            whole = [h.view(np.int64).tolist() for h in text_hashes(words)]
            usable = []
            for i, (key, text) in enumerate(zip(zip(*wanted, strict=True), zip(*whole, strict=True), strict=True)):
                if key[1:] == text and key not in seen:
                    seen.add(key)
                    usable.append(i)
            text, value, count = bags(*shingles(words, shingle))
            of = np.repeat(np.arange(len(text)), count)
            turn = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            unit = np.where(turn > 0, mix(value[of] + turn.astype(U64) * GOLDEN), value[of])
            edges = np.searchsorted(text[of], np.arange(batch.num_rows + 1))
            raw = [unit[edges[i] : edges[i + 1]].tobytes() for i in usable]
            chosen = [batch.column(k).take(pa.array(usable, pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*chosen, pa.array(raw, pa.binary())], ["rep", "places", "bag"])

    schema = T.StructType([*rows.select("rep", "places").schema.fields, T.StructField("bag", T.BinaryType())])
    return rows.select("rep", "places", "text").mapInArrow(bag, schema)


def overlaps(bags_of: list[np.ndarray], cut: int | None) -> np.ndarray:
    """Sizes of the intersections of all bags, or of those before ``cut`` with those after."""
    sizes = np.array([len(b) for b in bags_of])
    units, of = np.unique(np.concatenate(bags_of), return_inverse=True)
    owner = np.repeat(np.arange(len(bags_of)), sizes)
    shared = np.bincount(of, minlength=len(units)) > 1
    rank = np.cumsum(shared) - 1
    owner, column = owner[shared[of]], rank[of][shared[of]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    one = slice(0, cut) if cut is not None else slice(None)
    two = slice(cut, None) if cut is not None else slice(None)
    n = len(bags_of)
    total = np.zeros((n if cut is None else cut, n if cut is None else n - cut))
    for start in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, (start, start + COLUMNS_AT_ONCE))
        dense = np.zeros((n, COLUMNS_AT_ONCE), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        total += dense[one] @ dense[two].T
    return total


def _classified(docs: DataFrame, similarity: float, shingle: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``h1``, ``h2`` of every row, and ``class``: the least text that links reach.

    A text is named by the smallest id that has it and by its two hashes, so unlike texts of one
    id are told apart, and the least text of a class has its smallest id.
    """
    signed = staged(band_table(docs, shingle, bands, rows), "bag-minhash", "zstd")
    usable = signed.filter("bands IS NOT NULL AND doc_id IS NOT NULL")
    classes = usable.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = classes.select(F.struct("id", "h1", "h2").alias("rep"), "n", "bands")
    entries = classes.select("rep", F.posexplode("bands").alias("band", "key")).select(
        "rep", F.xxhash64("band", "key").alias("bucket")
    )
    leaders = entries.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
    stars = entries.join(leaders.filter("leader < last").drop("last"), "bucket").filter("leader < rep")
    groups = components(stars.select("leader", "rep").distinct()).select(
        F.col("node").alias("rep"), F.col("component").alias("candidates")
    )
    sized = groups.join(classes.select("rep", "n"), "rep")
    places = (
        block_pairs(sized, "candidates", "rep", BLOCK, "n", BLOCK_SHINGLES)
        .groupBy("rep")
        .agg(F.collect_list(F.struct("candidates", "left", "right", "side")).alias("places"))
        .withColumn("id", F.col("rep.id"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(places, "id")
    tasks = _bag_rows(texts, shingle).select("rep.*", "bag", F.inline("places"))

    def verify(table: pa.Table) -> pa.Table:
        names = ("id", "h1", "h2")
        table = table.sort_by([(x, "ascending") for x in ("side", *names)])
        # A row may be there several times, from several tasks.
        keys = np.stack([table[x].to_numpy() for x in names])
        table = table.filter(pa.array(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))))
        rep = [table[x].to_numpy() for x in names]
        side = table["side"].to_numpy()
        found = [np.frombuffer(b, U64) for b in table["bag"].to_pylist()]
        within = table["left"][0].as_py() == table["right"][0].as_py()
        cut = None if within else int((side == 0).sum())
        size = np.array([len(b) for b in found], np.float64)
        common = overlaps(found, cut)
        every = size[:, None] + size[None, :] if within else size[:cut, None] + size[None, cut:]
        linked = common / np.maximum(every - common, 1) >= similarity
        if within:
            roots, joined = forest(linked), linked.sum(axis=1) > 1
        else:
            roots = np.concatenate(bipartite_forest(linked))
            joined = np.concatenate((linked.any(axis=1), linked.any(axis=0)))
        columns = [x[joined] for x in rep] + [x[roots[joined]] for x in rep]
        return pa.table(dict(zip(("a", "b", "c", "x", "y", "z"), columns, strict=True)))

    links = tasks.groupBy("candidates", "left", "right").applyInArrow(
        verify, "a long, b long, c long, x long, y long, z long"
    )
    named = [F.struct(*(F.col(k).alias(n) for k, n in zip(c, ("id", "h1", "h2"), strict=True))) for c in ("abc", "xyz")]
    reached = components(links.select(named[0].alias("one"), named[1].alias("other"))).withColumnRenamed("node", "rep")
    named = classes.select("rep").join(reached, "rep", "left").select(
        "rep.h1", "rep.h2", F.coalesce("component", "rep").alias("class")
    )
    known = F.col("bands").isNotNull() & F.col("doc_id").isNotNull()
    members = signed.select("doc_id", *(F.when(known, F.col(h)).alias(h) for h in ("h1", "h2")))
    return members.join(named, ["h1", "h2"], "left")


def near_duplicates(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bands: int = 32, rows: int = 5
) -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest id reachable by links) and ``kept`` for every row."""
    own = F.coalesce("class.id", "doc_id")
    return _classified(docs, similarity, shingle, bands, rows).select(
        "doc_id", own.alias("class_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def one_of_each(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bands: int = 32, rows: int = 5
) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one for each class is kept.

    That is a row of the class's least text and id; of several rows with both, the one whose columns
    come first in order.  Texts without words stay, one for each id; rows without an id all stay.
    """
    found = _classified(docs.select("doc_id", "text"), similarity, shingle, bands, rows)
    found = staged(found.filter("doc_id IS NOT NULL"), "near-duplicates")
    least = F.col("class").isNull() | F.struct("doc_id", "h1", "h2").eqNullSafe(F.col("class"))
    # Where an id is there once, the id tells the row; else its text has to.
    per_id = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or(least).alias("least"))
    repeated = per_id.filter("n > 1").select(F.col("doc_id").alias("id"))
    gone = per_id.filter("n > 1 OR NOT least").select(F.col("doc_id").alias("id"))
    whole = docs.select(F.struct("*").alias("row")).withColumn("id", F.col("row.doc_id").cast("long"))
    once = whole.filter("id IS NOT NULL").join(gone, "id", "left_anti")
    again = _with_hashes(whole.join(repeated, "id", "left_semi"))
    stay = found.filter(least).select(F.col("doc_id").alias("id"), "h1", "h2").distinct()
    same = [again[c].eqNullSafe(stay[c]) for c in ("id", "h1", "h2")]
    again = again.join(stay, same[0] & same[1] & same[2], "left_semi")
    orderable = [f"row.`{f.name}`" for f in docs.schema if not _holds_map(f.dataType)]
    again = again.groupBy("id", "h1", "h2").agg(F.min_by("row", F.struct(*orderable)).alias("row"))
    return once.select("row").unionByName(again.select("row")).unionByName(
        whole.filter("id IS NULL").select("row")
    ).select("row.*")


def _holds_map(kind) -> bool:
    return "map<" in kind.simpleString()


def _with_hashes(rows: DataFrame) -> DataFrame:
    """Rows (``id``, ``row``) with the hashes of their text, null where it has no words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 2):
            words = words_of(batch.column(2))
            empty = pa.array(np.diff(words.first) == 0)
            whole = [pa.compute.if_else(empty, None, _signed(h)) for h in text_hashes(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *whole], ["id", "row", "h1", "h2"])

    longs = [T.StructField(name, T.LongType()) for name in ("h1", "h2")]
    schema = T.StructType([*rows.select("id", "row").schema.fields, *longs])
    return rows.select("id", "row", F.col("row.text").alias("text")).mapInArrow(hashed, schema)
