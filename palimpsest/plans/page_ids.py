"""Ids and titles of all article pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.revisions import articles


def features(pages: DataFrame, project: str) -> DataFrame:
    """One row per article page.

    ``pages`` is a page table, or a revisions table, where a page shows at its first revision.
    """
    rows = articles(pages)
    if "rev_pos" in rows.columns:
        rows = rows.where(F.col("rev_pos") == 0)
    return rows.select(
        "source_file", F.lit(project).alias("project"), "page_id", "page_title"
    )
