"""Bibliography sections of every article revision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.arrays import let
from palimpsest.functions.languages import check_language
from palimpsest.functions.matching import is_bibliography
from palimpsest.functions.wikitext import full_body, sections
from palimpsest.operators.counts import analyzed, one_per_element, scoped_counts
from palimpsest.operators.revisions import (
    articles,
    exactly_last,
    scoped,
    with_clean_text,
    with_last_flag,
)

# The counter of this job.
NAMES = "extracted-section-names"


def captured(revisions: DataFrame, language: str, only_last: bool = False) -> DataFrame:
    """Revisions with their text cut down to the bibliography sections.

    ``sections`` is ``array<struct<name, level>>``; revisions without any keep an empty one.
    """
    check_language(language)
    rows = with_clean_text(scoped(articles(revisions), only_last))

    def keep(found):
        return F.struct(
            F.array_join(F.transform(found, full_body), "").alias("text"),
            F.transform(
                found, lambda s: F.struct(s["name"].alias("name"), s["level"].alias("level"))
            ).alias("sections"),
        )

    kept = let(
        F.filter(sections(F.col("text")), lambda s: is_bibliography(s["name"], language)), keep
    )
    others = [c for c in rows.columns if c not in ("text", "chrono_pos")]
    narrow = rows.select(*others, kept.alias("_kept")).select(
        *others, F.col("_kept.text").alias("text"), F.col("_kept.sections").alias("sections")
    )
    return exactly_last(with_last_flag(narrow, articles(revisions)), revisions, only_last)


def name_counts(captures: DataFrame) -> DataFrame:
    return scoped_counts(one_per_element(captures, "sections.name", "name"), "source_file", "name")


def stats(captures: DataFrame) -> DataFrame:
    return name_counts(captures).select(
        "source_file", F.lit(NAMES).alias("counter"), "scope", F.col("name").alias("key"), "count"
    )


def performance(
    captures: DataFrame, pages: DataFrame | None = None, sources: DataFrame | None = None
) -> DataFrame:
    return analyzed(captures, pages, sources)
