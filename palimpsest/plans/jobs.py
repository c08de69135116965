"""Running a job: captures once, then features and counters, then the outputs.

Each function takes a revisions table, or a page table for page ids, and an output folder;
features go to ``<output>/<job>/features`` and counters to ``<output>/<job>/stats``, with one
folder per source file, also for files without an article.  ``output=None`` is a dry run: everything is computed, nothing is
written there.  ``pages``, the article pages of ``read_pages``, adds pages that have no
revisions to documents and totals.
"""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame

from palimpsest.functions.identifiers import Extractor
from palimpsest.operators.counts import source_files
from palimpsest.operators.relate import section_filter
from palimpsest.operators.revisions import with_last_flag
from palimpsest.plans import (
    bibliography,
    identifiers,
    identifiers_history,
    page_ids,
    sections_counter,
    wikilinks,
)
from palimpsest.session import staged
from palimpsest.sinks import documents, tables


class JobResult(NamedTuple):
    """What a job computed; ``None`` where a job has no such output."""

    features: DataFrame | None
    stats: DataFrame | None
    performance: DataFrame | None


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _write_stats(
    result: JobResult,
    counters: tuple[documents.Counter, ...],
    started: datetime,
    output: str | None,
    job: str,
    compression: str | None,
) -> None:
    fragments = documents.stats_document(
        result.performance, result.stats, counters, started, _now()
    )
    if output is None:
        tables.write_nowhere(fragments)
    else:
        documents.write_document(
            fragments, documents.STATS_KEYS, f"{output}/{job}/stats", compression
        )


def _write_pages(
    fragments: DataFrame, output: str | None, job: str, compression: str | None
) -> None:
    if output is None:
        tables.write_nowhere(fragments)
    else:
        documents.write_document(
            fragments, documents.KEYS, f"{output}/{job}/features", compression
        )


def extract_bibliography(
    revisions: DataFrame,
    output: str | None,
    language: str,
    only_last: bool = False,
    siteinfo: DataFrame | None = None,
    pages: DataFrame | None = None,
    compression: str | None = None,
) -> JobResult:
    """An export document of bibliography sections, and counts of their names."""
    tables.check_compression(compression)
    started = _now()
    captured = staged(bibliography.captured(revisions, language, only_last), "bibliography")
    sources = staged(source_files(revisions, siteinfo, pages), "sources")
    result = JobResult(
        captured,
        staged(bibliography.stats(captured), "bibliography-stats"),
        bibliography.performance(captured, pages, sources),
    )
    document = documents.bibliography_document(captured, siteinfo, only_last, pages, sources)
    _write_pages(document, output, "extract-bibliography", compression)
    _write_stats(
        result, documents.BIBLIOGRAPHY_STATS, started, output, "extract-bibliography", compression
    )
    return result


def extract_identifiers(
    revisions: DataFrame,
    output: str | None,
    filter_sections: str | None = None,
    language: str | None = None,
    only_last: bool = False,
    pages: DataFrame | None = None,
    compression: str | None = None,
    extractors: list[Extractor] | None = None,
) -> JobResult:
    """Identifier changes per revision, and counts of the places identifiers stand in."""
    tables.check_compression(compression)
    keep = section_filter(filter_sections, language)
    started = _now()
    captured = identifiers.captured(revisions, keep, only_last, extractors)
    captured = with_last_flag(staged(captured, "identifiers"))
    sources = staged(source_files(revisions, pages), "sources")
    features = identifiers.features(captured, only_last)
    result = JobResult(
        features,
        staged(identifiers.stats(captured, sources), "identifier-stats"),
        identifiers.performance(captured, pages, sources),
    )
    document = documents.identifiers_document(features, only_last, pages, sources)
    _write_pages(document, output, "extract-identifiers", compression)
    _write_stats(
        result, documents.IDENTIFIER_STATS, started, output, "extract-identifiers", compression
    )
    return result


def count_sections(
    revisions: DataFrame,
    output: str | None,
    only_last: bool = False,
    pages: DataFrame | None = None,
    compression: str | None = None,
) -> JobResult:
    """Counts of section names, of sections per revision and of revisions."""
    tables.check_compression(compression)
    started = _now()
    captured = staged(sections_counter.captured(revisions, only_last), "sections")
    sources = staged(source_files(revisions, pages), "sources")
    result = JobResult(
        None,
        staged(sections_counter.stats(captured), "section-stats"),
        sections_counter.performance(captured, pages, sources),
    )
    _write_stats(result, documents.SECTION_STATS, started, output, "count-sections", compression)
    return result


def extract_page_ids(
    pages: DataFrame, output: str | None, project: str, compression: str | None = None
) -> JobResult:
    features = page_ids.features(pages, project)
    if output is None:
        tables.write_nowhere(features)
    else:
        tables.write_page_ids(features, f"{output}/extract-page-ids/features", compression)
    return JobResult(features, None, None)


def extract_identifiers_history(
    revisions: DataFrame, output: str | None, project: str, compression: str | None = None
) -> JobResult:
    captured = staged(identifiers_history.captured(revisions), "identifiers-history")
    features = identifiers_history.history(captured, project)
    if output is None:
        tables.write_nowhere(features)
    else:
        tables.write_lifespans(
            features, f"{output}/extract-identifiers-history/features", compression
        )
    return JobResult(features, None, None)


def extract_wikilinks(
    revisions: DataFrame,
    output: str | None,
    language: str,
    only_last: bool = False,
    compression: str | None = None,
) -> JobResult:
    features = wikilinks.features(revisions, language, only_last)
    if output is None:
        tables.write_nowhere(features)
    else:
        tables.write_wikilinks(features, f"{output}/extract-wikilinks/features", compression)
    return JobResult(features, None, None)


JOBS = {
    "extract-bibliography": extract_bibliography,
    "extract-identifiers": extract_identifiers,
    "count-sections": count_sections,
    "extract-page-ids": extract_page_ids,
    "extract-identifiers-history": extract_identifiers_history,
    "extract-wikilinks": extract_wikilinks,
}
