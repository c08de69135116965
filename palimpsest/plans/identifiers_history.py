"""When each publication identifier was present in each article."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.identifiers import publication_identifiers
from palimpsest.operators.history import identifier_key, key_id, key_type, lifespans
from palimpsest.operators.revisions import articles, with_clean_text
from palimpsest.model import page_key


def captured(revisions: DataFrame) -> DataFrame:
    """Distinct identifier keys of each article revision; texts end here."""
    rows = with_clean_text(articles(revisions))
    chrono = ["chrono_pos"] if "chrono_pos" in rows.columns else []
    found = F.transform(publication_identifiers(F.col("text")), identifier_key)
    return rows.select(
        *page_key(rows), "page_title", "rev_id", "ts", *chrono, F.array_distinct(found).alias("ids")
    )


def features(revisions: DataFrame, project: str) -> DataFrame:
    """One row per page, identifier and interval; ``removed_ts`` is NULL while it is present."""
    return history(captured(revisions), project)


def history(captures: DataFrame, project: str) -> DataFrame:
    spans = lifespans(captures, "ids")
    return spans.select(
        "source_file",
        F.lit(project).alias("project"),
        "page_id",
        "page_title",
        key_type(F.col("item")).alias("identifier_type"),
        key_id(F.col("item")).alias("identifier_id"),
        "added_ts",
        "removed_ts",
    )
