"""Publication identifiers of article revisions: where they stand and how they change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.identifiers import Extractor
from palimpsest.model import page_key
from palimpsest.operators.counts import analyzed, class_counts
from palimpsest.operators.history import (
    identifier_key,
    key_id,
    key_type,
    one_per_change,
    with_changes,
)
from palimpsest.operators.relate import APPEARANCES, SectionFilter, located_identifiers
from palimpsest.operators.revisions import (
    articles,
    exactly_last,
    scoped,
    with_clean_text,
    with_last_flag,
)

# The counter of this job.
IDENTIFIERS = "identifiers"


def captured(
    revisions: DataFrame,
    keep_section: SectionFilter | None = None,
    only_last: bool = False,
    extractors: list[Extractor] | None = None,
) -> DataFrame:
    """Per article revision: keys of the identifiers in kept sections, and all appearances."""
    rows = with_clean_text(scoped(articles(revisions), only_last))
    located = located_identifiers(F.col("text"), keep_section, extractors)
    kept = F.filter(F.col("_found"), lambda i: i["in_sections"])
    others = [
        *page_key(rows),
        "page_title",
        "rev_pos",
        "rev_id",
        "user",
        "ts",
        *(["is_last"] if "is_last" in rows.columns else []),
    ]
    # Each of the two is left out where only the other is used.
    narrowed = rows.select(*others, located.alias("_found")).select(
        *others,
        F.array_distinct(F.transform(kept, identifier_key)).alias("ids"),
        F.transform(F.col("_found"), lambda i: i["appearance"]).alias("appearances"),
    )
    return exactly_last(narrowed, articles(revisions), only_last)


def features(captures: DataFrame, only_last: bool = False) -> DataFrame:
    """Every revision with its ``changes`` against the one before it in the file."""
    flag = ["is_last"] if "is_last" in captures.columns else []
    columns = [*page_key(captures), "page_title", "rev_pos", "rev_id", "user", "ts", *flag, "ids"]
    return with_changes(captures.select(*columns), "ids", "rev_pos", only_last).drop("ids", "block")


def diffs(features_: DataFrame) -> DataFrame:
    """One row per change."""
    page = page_key(features_)
    changed = one_per_change(features_, *page, "page_title", "rev_id", "user", "ts")
    return changed.select(
        *page,
        "page_title",
        "rev_id",
        "user",
        "ts",
        "action",
        key_type(F.col("item")).alias("type"),
        key_id(F.col("item")).alias("id"),
    )


def appearance_counts(captures: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    flagged = with_last_flag(captures.drop("ids", "user", "ts", "page_title"))
    return class_counts(flagged, "appearances", APPEARANCES, sources)


def stats(captures: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    return appearance_counts(captures, sources).select(
        "source_file", F.lit(IDENTIFIERS).alias("counter"), "scope", "key", "count"
    )


def performance(
    captures: DataFrame, pages: DataFrame | None = None, sources: DataFrame | None = None
) -> DataFrame:
    return analyzed(with_last_flag(captures), pages, sources)
