"""One wide row per article revision: changes, sections and bibliography together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.arrays import let
from palimpsest.functions.identifiers import publication_identifiers
from palimpsest.functions.languages import check_language
from palimpsest.functions.matching import is_bibliography
from palimpsest.functions.wikitext import full_body, references, sections
from palimpsest.model import page_key
from palimpsest.operators.history import changes, identifier_key, with_previous
from palimpsest.operators.revisions import articles, with_clean_text


def features(revisions: DataFrame, language: str) -> DataFrame:
    """``references_diff``, ``identifiers_diff``, ``sections`` and ``bibliography`` text.

    Both diffs compare with the revision before in the file, and share one shuffle.
    """
    check_language(language)
    rows = with_clean_text(articles(revisions))

    def outline(found):
        kept = F.filter(found, lambda s: is_bibliography(s["name"], language))
        return F.struct(
            F.transform(
                found, lambda s: F.struct(s["name"].alias("name"), s["level"].alias("level"))
            ).alias("sections"),
            F.array_join(F.transform(kept, full_body), "").alias("bibliography"),
        )

    flag = ["is_last"] if "is_last" in rows.columns else []
    reference_texts = F.transform(references(F.col("text")), lambda r: r["raw"])
    identifier_keys = F.transform(publication_identifiers(F.col("text")), identifier_key)
    narrow = rows.select(
        *page_key(rows),
        "page_title",
        "rev_pos",
        "rev_id",
        "user",
        "ts",
        *flag,
        F.struct(
            F.array_distinct(reference_texts).alias("references"),
            F.array_distinct(identifier_keys).alias("identifiers"),
        ).alias("items"),
        let(sections(F.col("text")), outline).alias("outline"),
    )
    return with_previous(narrow, "items", "rev_pos").select(
        *page_key(rows),
        "page_title",
        "rev_pos",
        "rev_id",
        "user",
        "ts",
        *flag,
        changes(F.col("items.references"), F.col("previous.references")).alias("references_diff"),
        changes(F.col("items.identifiers"), F.col("previous.identifiers")).alias(
            "identifiers_diff"
        ),
        F.col("outline.sections").alias("sections"),
        F.col("outline.bibliography").alias("bibliography"),
    )
