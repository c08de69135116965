"""XML documents, one per source file, written by many tasks.

A document is a table of text fragments with sort keys.  They are cut into ranges of these
keys and sorted, so the part files of a source file, taken in name order, are the document.
A page stays in one part file unless its history is longer than ``HISTORY_BLOCK`` revisions;
no task has to hold a whole document or a whole long history.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.model import HISTORY_BLOCK, PAGE_ORDINAL
from palimpsest.operators.counts import GLOBAL, LAST
from palimpsest.operators.history import ADDED, REMOVED, key_id, key_type
from palimpsest.operators.joins import null_safe_join
from palimpsest.operators.revisions import iso_timestamp
from palimpsest.plans import bibliography, identifiers, sections_counter
from palimpsest.sinks.tables import check_compression, source_name

# The root element of an export document.
EXPORT_ROOT = (
    '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/"'
    ' xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'
    ' version="0.10" xml:lang="en">'
)
GENERATOR = "palimpsest"

HEAD, BODY, FOOT = 0, 1, 2
KEYS = ("place", "page_id", "page_ordinal", "rev_pos")


def write_document(
    fragments: DataFrame, keys: tuple[str, ...], path: str, compression: str | None = None
) -> None:
    """Write ``fragment`` in order of ``keys``, one folder per source, named as its file is."""
    named = fragments.withColumn("uri", F.coalesce("source_file", F.lit("unknown"))).withColumn(
        "source_file", source_name(F.col("source_file"))
    )
    ranges = [
        F.floor(F.col(key) / HISTORY_BLOCK) if key == "rev_pos" else F.col(key) for key in keys
    ]
    (
        named.repartitionByRange("source_file", "uri", *ranges)
        .sortWithinPartitions("source_file", "uri", *keys)
        .select("source_file", "fragment")
        .write.partitionBy("source_file")
        .option("compression", check_compression(compression) or "none")
        .text(path)
    )


def _xml(tag: str, *fields: Column) -> Column:
    """An element; NULL fields are left out."""
    return F.to_xml(F.struct(*fields), {"rowTag": tag})


def _opened(tag: str, *fields: Column) -> Column:
    """The same without the closing tag."""
    return F.regexp_replace(_xml(tag, *fields), f"\\s*</{tag}>$", "")


def _ordinal(rows: DataFrame) -> Column:
    """The page's place in its file, where it is known: pages of one id do not mix."""
    name = PAGE_ORDINAL.name
    return F.col(name) if name in rows.columns else F.lit(None).cast(PAGE_ORDINAL.dataType).alias(name)


def _pages(
    rows: DataFrame, opening: Column, revision: Column, closing: str, only_last: bool
) -> DataFrame:
    """One fragment per revision; the first opens its page and the last closes it."""
    first = F.lit(True) if only_last else F.col("rev_pos") == 0
    empty = F.lit("")
    return rows.select(
        "source_file",
        F.lit(BODY).alias("place"),
        "page_id",
        _ordinal(rows),
        "rev_pos",
        F.concat(
            F.when(first, F.concat(opening, F.lit("\n"))).otherwise(empty),
            revision,
            F.when(F.col("is_last"), F.lit("\n" + closing)).otherwise(empty),
        ).alias("fragment"),
    )


def _pages_without_revisions(pages: DataFrame, opening: Column, closing: str) -> DataFrame:
    return pages.where(~F.col("has_revisions")).select(
        "source_file",
        F.lit(BODY).alias("place"),
        "page_id",
        _ordinal(pages),
        F.lit(0).alias("rev_pos"),
        F.concat(opening, F.lit("\n" + closing)).alias("fragment"),
    )


def _ends(sources: DataFrame, head: Column, foot: str) -> DataFrame:
    """The first and last fragment of each document."""
    parts = F.array(
        F.struct(F.lit(HEAD).alias("place"), head.alias("fragment")),
        F.struct(F.lit(FOOT).alias("place"), F.lit(foot).alias("fragment")),
    )
    sources = sources.select("source_file", F.inline(parts))
    return sources.select(
        "source_file",
        "place",
        F.lit(0).cast("bigint").alias("page_id"),
        _ordinal(sources),
        F.lit(0).alias("rev_pos"),
        "fragment",
    )


def _sources(rows: DataFrame) -> DataFrame:
    return rows.select("source_file").distinct()


def bibliography_document(
    captures: DataFrame,
    siteinfo: DataFrame | None = None,
    only_last: bool = False,
    pages: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> DataFrame:
    """Fragments of an export document whose texts are the bibliography sections.

    ``pages`` adds the article pages that have no revisions, ``sources`` the files that have
    no article.
    """
    files = _sources(captures if sources is None else sources)
    user = F.col("user")
    contributor = F.when(
        user.isNotNull(),
        F.struct(
            F.when(user["id"].isNotNull(), user["text"]).alias("username"),
            user["id"].alias("id"),
            F.when(user["id"].isNull(), user["text"]).alias("ip"),
        ),
    )
    revision = _xml(
        "revision",
        F.col("rev_id").alias("id"),
        F.col("parent_id").alias("parentid"),
        iso_timestamp(F.col("ts")).alias("timestamp"),
        contributor.alias("contributor"),
        F.when(F.col("minor"), F.lit("")).alias("minor"),
        F.col("comment"),
        F.col("model"),
        F.col("format"),
        F.col("text"),
        F.struct(
            F.transform(
                "sections",
                lambda s: F.struct(s["name"].alias("_name"), s["level"].alias("_level")),
            ).alias("section")
        ).alias("sections"),
    )
    # The XML writer takes no prefixed attribute names.  Inside values "<" is escaped.
    revision = F.replace(revision, F.lit("<text>"), F.lit('<text xml:space="preserve">'))
    opening = _opened(
        "page", F.col("page_title").alias("title"), F.col("ns"), F.col("page_id").alias("id")
    )
    if siteinfo is None:
        ends = _ends(files, F.lit(EXPORT_ROOT), "</mediawiki>")
    else:
        site = _xml(
            "siteinfo",
            F.col("sitename"),
            F.col("dbname"),
            F.col("base"),
            F.lit(GENERATOR).alias("generator"),
            F.col("case"),
            F.struct(
                F.transform(
                    "namespaces",
                    lambda n: F.struct(
                        n["key"].alias("_key"), n["case"].alias("_case"), n["name"].alias("_VALUE")
                    ),
                ).alias("namespace")
            ).alias("namespaces"),
        )
        known = siteinfo.select("source_file", site.alias("site"))
        named = null_safe_join(files, known, ["source_file"], "left")
        ends = _ends(named, F.concat_ws("\n", F.lit(EXPORT_ROOT), F.col("site")), "</mediawiki>")
    document = _pages(captures, opening, revision, "</page>", only_last).unionByName(ends)
    if pages is not None:
        document = document.unionByName(_pages_without_revisions(pages, opening, "</page>"))
    return document


def _grouped(action: str) -> Column:
    """The changes of one kind as a ``diff`` element."""
    items = F.transform(
        F.filter("changes", lambda c: c["action"] == action),
        lambda c: F.struct(key_type(c["item"]).alias("_type"), key_id(c["item"]).alias("_id")),
    )
    return F.struct(F.lit(action).alias("_action"), items.alias("identifier"))


def identifiers_document(
    features: DataFrame,
    only_last: bool = False,
    pages: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> DataFrame:
    """Fragments of the identifier changes; ``features`` needs ``changes`` and ``is_last``."""
    user = F.when(
        F.col("user").isNotNull(),
        F.struct(F.col("user.id").alias("_id"), F.col("user.text").alias("_name")),
    )
    groups = F.filter(
        F.array(_grouped(ADDED), _grouped(REMOVED)), lambda g: F.size(g["identifier"]) > 0
    )
    revision = _xml(
        "revision",
        F.col("rev_id").alias("id"),
        user.alias("user"),
        iso_timestamp(F.col("ts")).alias("timestamp"),
        F.struct(groups.alias("diff")).alias("publication-identifiers-diff"),
    )
    opening = F.concat(
        _opened("page", F.col("page_title").alias("title"), F.col("page_id").alias("id")),
        F.lit("\n<revisions>"),
    )
    closing = "</revisions>\n</page>"
    files = _sources(features if sources is None else sources)
    ends = _ends(files, F.lit("<root>"), "</root>")
    document = _pages(features, opening, revision, closing, only_last).unionByName(ends)
    if pages is not None:
        document = document.unionByName(_pages_without_revisions(pages, opening, closing))
    return document


def report_document(report: DataFrame) -> DataFrame:
    """Fragments of the wide revision report; ``report`` needs ``is_last``."""

    def grouped(column: str, action: str, item: str, value) -> Column:
        items = F.transform(F.filter(column, lambda c: c["action"] == action), value)
        return F.struct(F.lit(action).alias("_action"), items.alias(item))

    def diff(column: str, item: str, value) -> Column:
        groups = F.array(*[grouped(column, action, item, value) for action in (ADDED, REMOVED)])
        return F.struct(F.filter(groups, lambda g: F.size(g[item]) > 0).alias("diff"))

    revision = _xml(
        "revision",
        F.col("rev_id").alias("id"),
        F.when(
            F.col("user").isNotNull(),
            F.struct(F.col("user.id").alias("_id"), F.col("user.text").alias("_name")),
        ).alias("user"),
        iso_timestamp(F.col("ts")).alias("timestamp"),
        diff("references_diff", "reference", lambda c: c["item"]).alias("references_diff"),
        diff(
            "identifiers_diff",
            "identifier",
            lambda c: F.struct(key_type(c["item"]).alias("_type"), key_id(c["item"]).alias("_id")),
        ).alias("publication_identifiers_diff"),
        F.struct(
            F.transform(
                "sections",
                lambda s: F.struct(s["level"].alias("_level"), s["name"].alias("_VALUE")),
            ).alias("section")
        ).alias("sections"),
        F.col("bibliography"),
    )
    opening = F.concat(
        _opened("page", F.col("page_title").alias("title"), F.col("page_id").alias("id")),
        F.lit("\n<revisions>"),
    )
    ends = _ends(_sources(report), F.lit("<root>"), "</root>")
    return _pages(report, opening, revision, "</revisions>\n</page>", False).unionByName(ends)


class Counter(NamedTuple):
    """How a counter is written: its items' element and the attribute that holds the key.

    Without an element, the scopes themselves are the items.
    """

    name: str
    element: str | None
    attribute: str | None


# Elements of the statistics documents.
BIBLIOGRAPHY_STATS = (Counter(bibliography.NAMES, "section", "name"),)
IDENTIFIER_STATS = (Counter(identifiers.IDENTIFIERS, "appearance", "where"),)
SECTION_STATS = (
    Counter(sections_counter.NAMES, "section", "name"),
    Counter(sections_counter.SECTIONS, "sections", "number"),
    Counter(sections_counter.REVISIONS, None, None),
)
STATS_KEYS = ("position", "rank", "key")


def stats_document(
    performance: DataFrame,
    stats: DataFrame,
    counters: tuple[Counter, ...],
    started: datetime,
    ended: datetime,
) -> DataFrame:
    """Fragments of a statistics document: run times, totals and counters, largest first."""
    head = F.concat(
        F.lit("<stats>\n"),
        _xml(
            "performance",
            F.lit(started.isoformat(" ")).alias("start_time"),
            F.lit(ended.isoformat(" ")).alias("end_time"),
            F.col("revisions_analyzed"),
            F.col("pages_analyzed"),
        ),
    )
    frame: list[tuple[int, Column]] = [(0, head)]
    tables = []
    position = 1
    for counter in counters:
        rows = stats.where(F.col("counter") == counter.name)
        frame.append((position, F.lit(f"<{counter.name}>")))
        position += 1
        for scope in (GLOBAL, LAST):
            if counter.element is None:
                tag, key = scope, F.lit(None).cast("string").alias("_key")
            else:
                frame.append((position, F.lit(f"<{scope}>")))
                tag, key = counter.element, F.col("key").alias(f"_{counter.attribute}")
            tables.append(
                rows.where(F.col("scope") == scope).select(
                    "source_file",
                    F.lit(position + 1).alias("position"),
                    (-F.col("count")).alias("rank"),
                    "key",
                    _xml(tag, key, F.col("count").alias("_count")).alias("fragment"),
                )
            )
            position += 2
            if counter.element is not None:
                frame.append((position, F.lit(f"</{scope}>")))
                position += 1
        frame.append((position, F.lit(f"</{counter.name}>")))
        position += 1
    frame.append((position, F.lit("</stats>")))
    fixed = performance.select(
        "source_file",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(at).alias("position"), text.alias("fragment"))
                    for at, text in frame
                ]
            )
        ),
    ).select(
        "source_file",
        "position",
        F.lit(0).cast("bigint").alias("rank"),
        F.lit("").alias("key"),
        "fragment",
    )
    return reduce(DataFrame.unionByName, tables, fixed)
