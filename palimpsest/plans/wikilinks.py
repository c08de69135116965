"""Internal links of every article revision, with the section each link stands in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.languages import check_language
from palimpsest.functions.wikitext import sectioned_wikilinks
from palimpsest.operators.revisions import (
    articles,
    contributor,
    exactly_last,
    iso_timestamp,
    minor_flag,
    scoped,
    with_clean_text,
)


def features(revisions: DataFrame, language: str, only_last: bool = False) -> DataFrame:
    """One row per link.  ``language`` is checked, but links are read the same in all."""
    check_language(language)
    rows = with_clean_text(scoped(articles(revisions), only_last))
    place = [c for c in ("page_ordinal", "rev_pos", "is_last") if only_last and c in rows.columns]
    links = rows.select(
        *place,
        "page_id",
        "page_title",
        F.col("rev_id").alias("revision_id"),
        F.col("parent_id").alias("revision_parent_id"),
        iso_timestamp(F.col("ts")).alias("revision_timestamp"),
        *contributor(F.col("user")),
        minor_flag(F.col("minor")).alias("revision_minor"),
        "source_file",
        F.inline(sectioned_wikilinks(F.col("text"))),
    )
    return exactly_last(links, articles(revisions), only_last).select(
        "source_file",
        "page_id",
        "page_title",
        "revision_id",
        "revision_parent_id",
        "revision_timestamp",
        "user_type",
        "user_username",
        "user_id",
        "revision_minor",
        F.col("link").alias("wikilink_link"),
        F.col("anchor").alias("wikilink_anchor"),
        F.col("section_name").alias("wikilink_section_name"),
        F.col("section_level").alias("wikilink_section_level"),
        F.col("section_number").alias("wikilink_section_number"),
    )
