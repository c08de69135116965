"""SQL for the queries that run whole jobs and read their outputs back."""

from __future__ import annotations

from palimpsest.checks.oracle import (
    ART,
    BIB_TEXT,
    IS_BIBLIOGRAPHY,
    NAMES,
    ORACLE,
    REV,
    SECTIONS,
    appearance_counts,
    with_,
)

SIZED = """sized AS (SELECT art.source_file, art.is_last, CAST(count(sec.number) AS VARCHAR) AS n
FROM art LEFT JOIN sec ON sec.page_id = art.page_id AND sec.rev_pos = art.rev_pos
GROUP BY art.source_file, art.page_id, art.rev_pos, art.is_last)"""
ITEMS = """items AS (
SELECT source_file, 'section-names-per-revision' AS counter, name AS key, is_last FROM named
UNION ALL SELECT source_file, 'sections-per-revision', n, is_last FROM sized
UNION ALL SELECT source_file, 'revisions', NULL, is_last FROM art)"""
SCOPED_ITEMS = """counted AS (
SELECT source_file, counter, 'global' AS scope, key, count(*) AS count FROM items GROUP BY ALL
UNION ALL
SELECT source_file, counter, 'last_revision', key, count(*) FROM items WHERE is_last GROUP BY ALL)"""
PLACED = """SELECT source_file, counter, scope, key, count,
  row_number() OVER (PARTITION BY source_file, counter, scope ORDER BY count DESC, key) AS place FROM counted"""
SECTION_ITEMS = with_(ART, SECTIONS, NAMES, SIZED, ITEMS, SCOPED_ITEMS)

# The DOIs of the awkward texts: their spellings, in order, with what stands between them.
# Only the first, at offset 0, is taken in one mode and not in the other.
DOI_ROWS = """
WITH texts AS (
  SELECT doc_id, CAST(doc_id % 10 AS VARCHAR) AS k, CAST(doc_id % 7 AS VARCHAR) AS m,
    CAST(doc_id % 3 AS VARCHAR) AS n FROM documents
),
found AS (
  SELECT doc_id, unnest([
    {'id': '10.1111/z' || k, 'b': 0}, {'id': '10.2222/a(b' || m || ')[c]d', 'b': 11},
    {'id': '10.3333/{x}' || n, 'b': 31}, {'id': '10.4444/p<q>r', 'b': 46}, {'id': '10.5555/s', 'b': 63},
    {'id': '10.6666/t', 'b': 79}, {'id': '10.7777/v10.8888/w', 'b': 91}
  ], recursive := true) FROM texts
)
SELECT mode, doc_id, id, CAST(b AS INTEGER) AS span_begin, CAST(b + length(id) AS INTEGER) AS span_end
FROM found CROSS JOIN (VALUES ('skip'), ('all')) modes(mode) WHERE b > 0 OR mode = 'all'
"""

ORACLE |= {
    "page_ids_csv_read_back": with_(REV)
    + """SELECT DISTINCT source_file, 'enwiki' AS project, page_id, page_title, true AS is_gzip
FROM rev WHERE ns = 0""",
    "identifiers_document_read_back": ORACLE["identifier_diffs"].replace(
        "user_name, ts, action, type, id\n", "user_name, ts, action, type, id AS identifier\n"
    ),
    "section_stats_document": SECTION_ITEMS + PLACED,
    "identifier_stats_document": f"""WITH counted AS (
SELECT source_file, 'identifiers' AS counter, scope, key, count FROM ({with_(ART, appearance_counts("true"))}))
"""
    + PLACED,
    "bibliography_stats_document": with_(
        ART,
        SECTIONS,
        f"""items AS (SELECT source_file, 'extracted-section-names' AS counter, name AS key, is_last
FROM sec JOIN art USING (page_id, rev_pos) WHERE {IS_BIBLIOGRAPHY})""",
        SCOPED_ITEMS,
    )
    + PLACED,
    "run_totals_document": with_(ART)
    + """SELECT source_file, count(DISTINCT page_id) AS pages_analyzed, count(*) AS revisions_analyzed,
  true AS in_order FROM art GROUP BY ALL""",
    "dry_run_counts": SECTION_ITEMS + "SELECT * FROM counted",
    "most_common_sections": SECTION_ITEMS
    + f"""SELECT source_file, scope, key, count, place FROM ({PLACED})
WHERE counter = 'section-names-per-revision'""",
    "siteinfo_read_back": with_(REV)
    + """SELECT DISTINCT source_file AS source, 'Wiki & ' || source_file AS sitename, 'wiki' AS dbname,
  'http://example.org/' AS base, 'first-letter' AS site_case, namespace, namespace_case, namespace_name
FROM rev CROSS JOIN (VALUES (0, 'first-letter', NULL), (1, 'case-sensitive', 'Talk'))
  n(namespace, namespace_case, namespace_name)""",
    "whole_pages_read_back": with_(ART, SECTIONS, BIB_TEXT)
    + """SELECT source_file AS source, page_id, page_title, ns, rev_pos, rev_id, parent_id, ts,
  md5(coalesce(body, '')) AS text_md5, is_last,
  CAST(row_number() OVER (PARTITION BY page_id ORDER BY ts, rev_id, rev_pos) - 1 AS INTEGER) AS chrono_pos
FROM art LEFT JOIN bib USING (page_id, rev_pos)""",
    "siteinfo_violations": with_(REV)
    + """SELECT source_file, "where", value FROM (
SELECT DISTINCT source_file, 'site' AS "where", 'upper' AS value FROM rev WHERE source_file = 'history-1'
UNION ALL SELECT DISTINCT source_file, 'namespace 1', 'case-sensitives' FROM rev)""",
    "section_level_violations": with_(ART, SECTIONS)
    + "SELECT page_id, rev_id, number, name, level - 2 AS level FROM sec WHERE level <= 2",
    "language_checks": """SELECT lang, count(*) AS documents, CASE WHEN lang IS NULL OR lang NOT IN ('en', 'it')
  THEN 'language must be one of en, it, not ' || coalesce(chr(39) || lang || chr(39), 'None') END AS refusal
FROM documents GROUP BY lang""",
    "supported_languages": "SELECT doc_id, lang, lang IN ('en', 'it') AS is_supported FROM documents",
    "doi_rules": DOI_ROWS,
}
