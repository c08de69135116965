"""Counters over all revisions and over last revisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.joins import null_safe_join

# The two scopes of every counter.
GLOBAL = "global"
LAST = "last_revision"


def scoped_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows per key in both scopes as ``(*keys, scope, count)``; zero counts are left out.

    ``rows`` needs ``is_last``.  Both scopes come from one partial aggregation.
    """
    counted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("is_last")).alias("_last")
    )
    return counted.select(*keys, _by_scope(F.col("_all"), F.col("_last"))).where("count > 0")


def one_per_element(rows: DataFrame, array: str, name: str) -> DataFrame:
    """``source_file``, ``is_last`` and each element of ``array`` as ``name``.

    An inner ``explode`` would make the optimizer test the array's size in a filter of its
    own, and so extract it from the text twice.
    """
    exploded = rows.select("source_file", "is_last", F.explode_outer(array).alias(name))
    return exploded.where(F.col(name).isNotNull())


def _by_scope(in_all: Column, in_last: Column) -> Column:
    return F.inline(
        F.array(
            F.struct(F.lit(GLOBAL).alias("scope"), in_all.alias("count")),
            F.struct(F.lit(LAST).alias("scope"), in_last.alias("count")),
        )
    )


def source_files(*tables: DataFrame | None) -> DataFrame:
    """Every ``source_file`` that one of the tables names."""
    named = [table.select("source_file") for table in tables if table is not None]
    return reduce(DataFrame.unionByName, named).distinct()


def _for_every(sources: DataFrame | None, counted: DataFrame) -> DataFrame:
    """``counted`` with zeros for the source files that it lacks."""
    if sources is None:
        return counted
    joined = null_safe_join(sources.select("source_file").distinct(), counted, ["source_file"], "left")
    return joined.fillna(0, [c for c in counted.columns if c != "source_file"])


def class_counts(
    rows: DataFrame, classes: str, names: tuple[str, ...], sources: DataFrame | None = None
) -> DataFrame:
    """Occurrences of each of ``names`` in the array column ``classes``, per source and scope.

    Classes that never occur are reported with 0, and so are all classes for those of
    ``sources`` that have no rows.
    """
    per_row = rows.select(
        "source_file", "is_last", *[_occurrences(F.col(classes), n).alias(n) for n in names]
    )
    sums = []
    for name in names:
        sums.append(F.sum(name).alias(f"all_{name}"))
        sums.append(F.sum(F.when(F.col("is_last"), F.col(name)).otherwise(0)).alias(f"last_{name}"))
    summed = _for_every(sources, per_row.groupBy("source_file").agg(*sums))
    entries = [
        F.struct(
            F.lit(scope).alias("scope"),
            F.lit(name).alias("key"),
            F.col(f"{prefix}_{name}").alias("count"),
        )
        for scope, prefix in ((GLOBAL, "all"), (LAST, "last"))
        for name in names
    ]
    return summed.select("source_file", F.inline(F.array(*entries)))


def _occurrences(values: Column, name: str) -> Column:
    return F.size(F.filter(values, lambda value: value == name))


def analyzed(
    rows: DataFrame, pages: DataFrame | None = None, sources: DataFrame | None = None
) -> DataFrame:
    """``pages_analyzed`` and ``revisions_analyzed`` per source; ``rows`` needs ``is_last``.

    A page has exactly one last revision, so pages are counted without a distinct.  Pages
    that have no revisions only count when the page table is given.  Those of ``sources``
    without any page are reported with 0.
    """
    seen = rows.select(
        "source_file", F.col("is_last").alias("ends_page"), F.lit(True).alias("is_revision")
    )
    if pages is not None:
        seen = seen.unionByName(
            pages.where(~F.col("has_revisions")).select(
                "source_file", F.lit(True).alias("ends_page"), F.lit(False).alias("is_revision")
            )
        )
    counted = seen.groupBy("source_file").agg(
        F.count_if("ends_page").alias("pages_analyzed"),
        F.count_if("is_revision").alias("revisions_analyzed"),
    )
    return _for_every(sources, counted)


def grand_total(stats: DataFrame) -> DataFrame:
    """Counters of all source files together."""
    return stats.groupBy("counter", "scope", "key").agg(F.sum("count").alias("count"))


def most_common(counted: DataFrame, *keys: str) -> DataFrame:
    """Order by count, largest first; ties by key."""
    return counted.orderBy("source_file", "scope", F.desc("count"), *keys)
