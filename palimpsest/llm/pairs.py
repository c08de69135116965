"""Comparing all members of groups without ever holding a large group or listing its pairs.

A group of up to ``size`` members is one task.  A larger one is cut into blocks, and every pair
of blocks is a task, so the work of a hot group is spread and each task stays bounded.  A task
compares its members as matrices and returns a spanning forest of the links found, at most one
row for each member.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(
    rows: DataFrame, group: str, member: str, size: int, weight: str | None = None, most: int = 0
) -> DataFrame:
    """``rows`` with ``left`` and ``right`` block numbers and ``side``, once for each block pair.

    Members of groups of one are left out.  ``side`` is 0 for members of the left block, 1 for
    those of the right; in the pair of a block with itself all are on side 0.  Blocks are made so
    many that each has some ``size`` members, and where ``weight`` is named, ``most`` of that.
    """
    blocks = F.ceil(F.count("*") / size)
    if weight:
        blocks = F.greatest(blocks, F.ceil(F.sum(weight) / most))
    sizes = rows.groupBy(group).agg(F.count("*").alias("members"), blocks.cast("int").alias("blocks"))
    cut = rows.join(sizes.filter("members > 1"), group)
    cut = cut.withColumn("own", F.pmod(F.xxhash64(member), "blocks").cast("int"))
    return (
        cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left", F.least("own", "other"))
        .withColumn("right", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .drop("members", "blocks", "own", "other")
    )


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the least index reachable from it."""
    n = len(linked)
    label = np.arange(n)
    if not linked.any():
        return label
    while True:
        near = np.where(linked, label[None, :], n).min(axis=1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return label
        label = new


def bipartite_forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for rows and columns of a matrix of links between them; columns count after rows."""
    n, m = linked.shape
    rows, columns = np.arange(n), np.arange(n, n + m)
    if not linked.any():
        return rows, columns
    while True:
        new_columns = np.minimum(columns, np.where(linked, rows[:, None], n + m).min(axis=0))
        new_rows = np.minimum(rows, np.where(linked, new_columns[None, :], n + m).min(axis=1))
        if np.array_equal(new_rows, rows) and np.array_equal(new_columns, columns):
            return rows, columns
        rows, columns = new_rows, new_columns
