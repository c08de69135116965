"""Section names and numbers of sections per article revision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import strip_blanks
from palimpsest.functions.wikitext import section_names
from palimpsest.model import page_key
from palimpsest.operators.counts import analyzed, one_per_element, scoped_counts
from palimpsest.operators.revisions import (
    articles,
    exactly_last,
    scoped,
    with_clean_text,
    with_last_flag,
)

# The three counters of this job.
NAMES = "section-names-per-revision"
SECTIONS = "sections-per-revision"
REVISIONS = "revisions"


def captured(revisions: DataFrame, only_last: bool = False) -> DataFrame:
    """Normalised section names of each article revision."""
    rows = with_clean_text(scoped(articles(revisions), only_last))
    flag = ["is_last"] if "is_last" in rows.columns else []
    names = F.transform(section_names(F.col("text")), lambda n: F.lower(strip_blanks(n)))
    narrow = rows.select(*page_key(rows), "rev_pos", *flag, names.alias("names"))
    return exactly_last(with_last_flag(narrow, articles(revisions)), revisions, only_last)


def name_counts(captures: DataFrame) -> DataFrame:
    return scoped_counts(one_per_element(captures, "names", "name"), "source_file", "name")


def section_counts(captures: DataFrame) -> DataFrame:
    """How many revisions have how many sections, revisions without any included."""
    sized = captures.select("source_file", "is_last", F.size("names").alias("sections"))
    return scoped_counts(sized, "source_file", "sections")


def revision_counts(captures: DataFrame) -> DataFrame:
    return scoped_counts(captures.select("source_file", "is_last"), "source_file")


def stats(captures: DataFrame) -> DataFrame:
    """All counters as ``(source_file, counter, scope, key, count)``."""
    parts = (
        (NAMES, name_counts(captures).withColumnRenamed("name", "key")),
        (SECTIONS, section_counts(captures).withColumn("key", F.col("sections").cast("string"))),
        (REVISIONS, revision_counts(captures).withColumn("key", F.lit(None).cast("string"))),
    )
    tables = [
        table.select("source_file", F.lit(counter).alias("counter"), "scope", "key", "count")
        for counter, table in parts
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def performance(
    captures: DataFrame, pages: DataFrame | None = None, sources: DataFrame | None = None
) -> DataFrame:
    return analyzed(captures, pages, sources)
