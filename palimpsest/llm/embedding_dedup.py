"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors at cosine c lie sqrt(2 - 2c) apart.  Each of ``tables`` hash tables quantises
``projections`` Gaussian projections of a vector, shifted at random, in steps of ``width``; the
vectors of one label that agree in all of them share a bucket.  With the default of 60 tables,
10 projections and width 1, two vectors at cosine 0.98 share a bucket of some table with
probability 1 - 1e-5, closer ones more surely, while unrelated ones do so once in 500,000 per
table.  Whatever shares a bucket is compared exactly, in double precision.

Equal vectors of a label are one class and are compared once.  Buckets of one class are dropped
before vectors move; buckets of many are compared in pairs of blocks (``pairs``), so that a hot
bucket is spread and no list of pairs is written: a task returns for each vector how many
others it is linked with, leaving out pairs that an earlier table holds too, and a spanning
forest of the links for ``components``.

Defined results: a vector that is null, empty, zero, or holds a null or a non-finite number,
and one without label or id, links with nothing and is its own component; vectors of different
length do not link; every row counts as a vector of its own, repeated rows too; an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.components import components
from palimpsest.llm.pairs import bipartite_forest, block_pairs, forest
from palimpsest.llm.words import U64, mix
from palimpsest.session import staged

BLOCK = 1024
ROWS_AT_ONCE = 2048
SEED = 20240611


@lru_cache(maxsize=8)
def _projections(dimension: int, tables: int, projections: int, width: float):
    random = np.random.default_rng(SEED)
    n = tables * projections
    return random.standard_normal((dimension, n)) / width, random.random(n)


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """A 64-bit key of each normalised vector's bucket, for each table."""
    directions, shifts = _projections(vectors.shape[1], tables, projections, width)
    cells = np.floor(vectors @ directions + shifts).astype(np.int64).view(U64)
    keys = np.zeros((len(vectors), tables), U64) + np.arange(1, tables + 1, dtype=U64)
    for k in range(projections):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + cells[:, k::projections])
    return keys


def normalised(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their class's two hashes, and the classes."""
    usable = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND exists(v, x -> x != 0D) AND NOT exists("
        "v, x -> x IS NULL OR isnan(x) OR x = double('infinity') OR x = double('-infinity'))"
    )
    rows = vectors.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    ).withColumns({"h1": F.xxhash64("label", "v"), "h2": F.xxhash64("v", "label"), "usable": usable})
    classes = (
        rows.filter("usable")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    )
    members = rows.select(
        "vec_id", F.when(F.col("usable"), F.col("h1")).alias("h1"), F.when(F.col("usable"), F.col("h2")).alias("h2")
    )
    return members, classes


def embedding_dedup(
    vectors: DataFrame, threshold: float = 0.98, tables: int = 60, projections: int = 10, width: float = 1.0
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    members, classes = _classes(vectors)

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                lists = batch.column(batch.schema.get_field_index("v"))
                sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
                for size in np.unique(sizes):
                    some = batch.filter(pa.array(sizes == size))
                    column = some.column(some.schema.get_field_index("v"))
                    unit = normalised(column.flatten().to_numpy().reshape(-1, size))
                    keys = bucket_keys(unit, tables, projections, width)
                    columns = {name: some.column(i) for i, name in enumerate(some.schema.names)}
                    columns["v"] = pa.array([row.tobytes() for row in unit], pa.binary())
                    columns["keys"] = pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    label = classes.schema["label"].dataType.simpleString()
    hashed = staged(
        classes.mapInArrow(hash_rows, f"h1 long, h2 long, rep long, n long, label {label}, v binary, keys array<long>"),
        "vector-classes",
    )
    entries = hashed.select("rep", F.length("v").alias("bytes"), "label", F.posexplode("keys").alias("table", "key"))
    entries = entries.select("rep", "table", F.xxhash64("label", "bytes", "table", "key").alias("bucket"))
    payload = hashed.select("rep", "n", "v", "keys")
    tasks = block_pairs(entries, "bucket", "rep", BLOCK).join(payload, "rep")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("rep", "ascending")])
        number = table["table"][0].as_py()
        rep, n, side = (table[c].to_numpy() for c in ("rep", "n", "side"))
        unit = np.frombuffer(b"".join(table["v"].to_pylist())).reshape(len(rep), -1)
        keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        cut = int((side == 0).sum())
        one, two = slice(0, cut), slice(cut, None)
        within = table["left"][0].as_py() == table["right"][0].as_py()
        if within:
            two = one
        linked = unit[one] @ unit[two].T >= threshold
        if within:
            np.fill_diagonal(linked, False)
        first = linked.copy()
        if linked.any():
            for t in range(number):
                first &= keys[one, t][:, None] != keys[two, t][None, :]
        counts = first @ n[two].astype(np.float64)
        if within:
            roots = forest(linked)
        else:
            roots = np.concatenate(bipartite_forest(linked))
            counts = np.concatenate((counts, first.T @ n[one].astype(np.float64)))
        joined = np.concatenate((linked.any(axis=1), [] if within else linked.any(axis=0))).astype(bool)
        found = pa.Table.from_arrays(
            [pa.array(rep[: len(roots)]), pa.array(counts.astype(np.int64)), pa.array(rep[roots])],
            ["rep", "links", "root"],
        )
        return found.filter(pa.array(joined))

    found = staged(
        tasks.groupBy("bucket", "left", "right").applyInArrow(compare, "rep long, links long, root long"),
        "vector-links",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select("rep", "root")).withColumnRenamed("node", "rep")
    classes = hashed.select("h1", "h2", "rep", "n").join(links, "rep", "left").join(reached, "rep", "left")
    rows = members.join(classes, ["h1", "h2"], "left")
    component = F.coalesce("component", "rep", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
