"""Connected components of a large graph, by alternating stars over DataFrames.

Each round rewrites the links: a node's larger neighbours, then its smaller ones, are linked to
the smallest node among them.  The rounds needed grow with the logarithm of a component's size;
a node with a great many links is only ever aggregated with partial sums and joined back.  Each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import staged


def _star(links: DataFrame) -> DataFrame:
    """Link every node to the least node that its larger node is linked to (small star)."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(least, "high")
    return joined.select(F.col("least").alias("low"), F.col("low").alias("high")).unionByName(
        least.select(F.col("least").alias("low"), "high")
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its least neighbour, or to itself."""
    both = links.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
        links.select(F.col("high").alias("node"), F.col("low").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("least").alias("low"), F.col("other").alias("high"))
    )


def _clean(links: DataFrame) -> DataFrame:
    return links.filter("low < high").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of all nodes that have a link.

    ``links`` has two columns of node ids, in any order and with repeats; links of a node with
    itself and nulls are ignored.
    """
    one, two = links.columns
    rows = links.filter(F.col(one).isNotNull() & F.col(two).isNotNull()).select(
        F.least(one, two).alias("low"), F.greatest(one, two).alias("high")
    )
    rows, before = staged(_clean(rows), "links"), None
    while True:
        # Stars are done when their number and sums no longer change.
        mark = rows.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        rows = staged(_clean(_star(_clean(_large_star(rows)))), "links")
    leaves = rows.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
