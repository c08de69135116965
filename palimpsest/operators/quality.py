"""Revision graph and integrity checks of a dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.model import PAGE_KEY, page_key
from palimpsest.operators.joins import null_safe_join

# The export schema's value patterns and enumerations.
MODEL_PATTERN = r"^[a-zA-Z][\-+./a-zA-Z0-9]*$"
FORMAT_PATTERN = r"^[a-zA-Z][\-+.a-zA-Z0-9]*/[a-zA-Z][\-+.a-zA-Z0-9]*$"
CASES = ("first-letter", "case-sensitive", "case-insensitive")


def revision_edges(revisions: DataFrame) -> DataFrame:
    """Parent to child edges of each page's revisions; a first revision has no parent."""
    return revisions.select(*page_key(revisions), "parent_id", "rev_id", "ts")


def dangling_parents(revisions: DataFrame) -> DataFrame:
    """Edges whose parent is not a revision of the same page."""
    edges = revision_edges(revisions).where(F.col("parent_id").isNotNull())
    page = page_key(revisions)
    known = revisions.select(*page, F.col("rev_id").alias("parent_id"))
    return null_safe_join(edges, known, [*page, "parent_id"], "left_anti").select(
        *page, "parent_id", "rev_id", "ts"
    )


def duplicate_ids(revisions: DataFrame) -> DataFrame:
    """Page and revision ids that occur more than once in a file: ``(kind, source_file, id, n)``.

    A page is counted at its first revision.
    """
    kinds = F.when(
        F.col("rev_pos") == 0,
        F.array(
            F.struct(F.lit("page").alias("kind"), F.col("page_id").alias("id")),
            F.struct(F.lit("revision").alias("kind"), F.col("rev_id").alias("id")),
        ),
    ).otherwise(F.array(F.struct(F.lit("revision").alias("kind"), F.col("rev_id").alias("id"))))
    return (
        revisions.select("source_file", F.inline(kinds))
        .groupBy("kind", "source_file", "id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def _violated(condition: Column) -> Column:
    """Whether a required condition fails, a missing value included."""
    return ~F.coalesce(condition, F.lit(False))


def constraint_violations(revisions: DataFrame) -> DataFrame:
    """Values outside the export schema: ``(source_file, page_id, rev_id, rule, value)``."""
    col = F.col
    rules = {
        "ns_not_negative": (_violated(col("ns") >= 0), col("ns")),
        "page_id_positive": (_violated(col("page_id") > 0), col("page_id")),
        "rev_id_positive": (_violated(col("rev_id") > 0), col("rev_id")),
        "parent_id_positive": (col("parent_id") <= 0, col("parent_id")),
        "title_present": (col("page_title").isNull(), col("page_title")),
        "timestamp_present": (col("ts").isNull(), col("ts")),
        "model_pattern": (_violated(col("model").rlike(MODEL_PATTERN)), col("model")),
        "format_pattern": (_violated(col("format").rlike(FORMAT_PATTERN)), col("format")),
    }
    entries = F.array(
        *[
            F.when(
                broken, F.struct(F.lit(rule).alias("rule"), value.cast("string").alias("value"))
            )
            for rule, (broken, value) in rules.items()
        ]
    )
    return revisions.select(
        *PAGE_KEY, "rev_id", F.inline(F.filter(entries, lambda e: e.isNotNull()))
    )


def siteinfo_violations(siteinfo: DataFrame) -> DataFrame:
    """Site-level or namespace-level case settings outside the enumeration."""
    cases = F.concat(
        F.array(F.struct(F.lit("site").alias("where"), F.col("case").alias("value"))),
        F.transform(
            F.coalesce("namespaces", F.array().cast("array<struct<key:int,case:string,name:string>>")),
            lambda n: F.struct(
                F.concat(F.lit("namespace "), n["key"].cast("string")).alias("where"),
                n["case"].alias("value"),
            ),
        ),
    )
    return siteinfo.select("source_file", F.inline(cases)).where(
        F.col("value").isNotNull() & ~F.col("value").isin(*CASES)
    )


def section_level_violations(sections: DataFrame) -> DataFrame:
    """Extracted section rows whose level is not positive."""
    return sections.where(~F.coalesce(F.col("level") > 0, F.lit(False)))
