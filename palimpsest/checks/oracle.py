"""SQL for each query, written against the tables in another way than the Spark code.

Pattern matches are located by splitting the text and summing piece lengths over a window;
containment is a correlated EXISTS; sections are found by an as-of join; lifespans are
gaps and islands over revision ranks.
"""

from __future__ import annotations

from palimpsest.sources import tables as src

# The same constructs in a dialect without back-references.
COMMENT = r"(?s)<!--.*?-->"
HEADER = r"(?m)^={1,7}[^=\n]+={1,7}\s*$"
REFERENCE = r"(?is)<ref.*?</ref>"
TEMPLATE = r"(?s)\{\{.*?\}\}"
CITATION = r"(?s)\{\{\s*(?:Citation|cite|vcite)\s+.*?\}\}"
LINK = r"\[\[([^\n|\]\[#<>{}]{0,256})(?:\|([^\[]*?))?\]\]"
ARXIV = tuple(
    rf"(?i)({prefix})(?:(-?)((?:[a-z]+(?:.[a-z]+)/)?[0-9]{{4}}[0-9]+)|([0-9]{{4}}.[0-9]+)(?:v[0-9]+)?)"
    for prefix in (r"arxiv\s*=\s*", r"//arxiv\.org/(?:abs/)?", r"arxiv:\s?")
)
DOI = r"10\.[0-9]{4,}/[^\s|?#<\]}]*"
GROUP_IDS = (
    ("isbn", r"(?i)isbn\s?=?\s?([0-9\-Xx]+)"),
    ("pmid", r"(?i)\bpmid\s*=\s*(?:pmc)?([0-9]+)\b"),
    ("pmid", r"(?i)//www\.ncbi\.nlm\.nih\.gov/pubmed/([0-9]+)\b"),
    ("pmc", r"(?i)\bpmc\s*=\s*(?:pmc)?([0-9]+)\b"),
    ("pmc", r"(?i)//www\.ncbi\.nlm\.nih\.gov/pmc/articles/PMC([0-9]+)\b"),
)
# Which of the section names in the texts are bibliography headings.
BIBLIOGRAPHY_NAMES = (
    "'references', 'refernces', 'reference', 'further reading', 'sources', 'bibliography',"
    " 'foot notes'"
)
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

REV = f"""rev AS (
SELECT {src.CONVERSATION_FILE} AS source_file, conv_id AS page_id,
  CAST({src.CONVERSATION_NS} AS INTEGER) AS ns, {src.CONVERSATION_TITLE} AS page_title,
  CAST(turn AS INTEGER) AS rev_pos, {src.CONVERSATION_REV_ID} AS rev_id,
  {src.CONVERSATION_PARENT_ID} AS parent_id,
  strftime({src.FIRST_TIMESTAMP} + to_hours(CAST({src.CONVERSATION_HOUR} AS BIGINT)), {ISO}) AS ts,
  {src.CONVERSATION_USER_ID} AS user_id, {src.CONVERSATION_USER_TEXT} AS user_name,
  turn % 3 = 1 AS minor, {src.CONVERSATION_COMMENT} AS comment, {src.CONVERSATION_MODEL} AS model, 'text/x-wiki' AS format,
  {src.CONVERSATION_TEXT} AS raw_text,
  turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
FROM conversations)"""

ART = f"""{REV}, art AS (
SELECT *, regexp_replace(coalesce(raw_text, ''), '{COMMENT}', '', 'g') AS t FROM rev WHERE ns = 0)"""

DOCS = f"""art AS (
SELECT 'articles-' || source AS source_file, doc_id AS page_id, 0 AS rev_pos, doc_id + 1 AS rev_id,
  'Article ' || CAST(doc_id AS VARCHAR) AS page_title, true AS is_last,
  regexp_replace(coalesce({src.DOCUMENT_TEXT}, ''), '{COMMENT}', '', 'g') AS t FROM documents)"""


def spans(name: str, pattern: str) -> str:
    """CTEs that end in ``name(page_id, rev_pos, rev_id, i, raw, b, e)``."""
    return f"""{name}_m AS (
SELECT page_id, rev_pos, rev_id, regexp_extract_all(t, '{pattern}') AS m,
  string_split_regex(t, '{pattern}') AS pieces FROM art),
{name}_u AS (
SELECT page_id, rev_pos, rev_id, unnest(m) AS raw, unnest(pieces[1:len(m)]) AS gap,
  generate_subscripts(m, 1) AS i FROM {name}_m WHERE len(m) > 0),
{name} AS (
SELECT page_id, rev_pos, rev_id, CAST(i AS INTEGER) AS i, raw, e - length(raw) AS b, e FROM (
  SELECT *, CAST(sum(length(gap) + length(raw)) OVER (
    PARTITION BY page_id, rev_pos ORDER BY i) AS INTEGER) AS e FROM {name}_u))"""


SECTIONS = f"""{spans('h', HEADER)},
sec AS (
SELECT page_id, rev_pos, rev_id, i AS number, regexp_extract(raw, '^=+([^=\\n]+)=+', 1) AS name,
  CAST(length(regexp_extract(raw, '^=+')) AS INTEGER) AS level, b, e, coalesce(nb - 1, n) AS se,
  substr(t, CAST(e + 2 AS BIGINT), CAST(greatest(coalesce(nb - 1, n) - (e + 1), 0) AS BIGINT)) AS body
FROM (SELECT h.*, art.t, CAST(length(art.t) AS INTEGER) AS n,
  lead(h.b) OVER (PARTITION BY h.page_id, h.rev_pos ORDER BY h.i) AS nb
  FROM h JOIN art USING (page_id, rev_pos)))"""

PREAMBLE = """pre AS (
SELECT art.page_id, art.rev_pos, art.rev_id, 0 AS number, '' AS name, 0 AS level, 0 AS b,
  CAST(coalesce(min(h.b) - 1, length(any_value(art.t))) AS INTEGER) AS se,
  substr(any_value(art.t), 1, CAST(greatest(coalesce(min(h.b) - 1, length(any_value(art.t))), 0) AS BIGINT)) AS body
FROM art LEFT JOIN h ON h.page_id = art.page_id AND h.rev_pos = art.rev_pos
GROUP BY art.page_id, art.rev_pos, art.rev_id),
allsec AS (
SELECT page_id, rev_pos, rev_id, number, name, level, b, se, body FROM pre
UNION ALL SELECT page_id, rev_pos, rev_id, number, name, level, b, se, body FROM sec)"""

LINKS = f"""{spans('l', LINK)},
links AS (
SELECT page_id, rev_pos, rev_id, CASE WHEN link = '' THEN anchor ELSE link END AS link, anchor, b, e FROM (
  SELECT *, trim(replace(CASE WHEN shown = '' THEN link ELSE shown END, chr(10), ' ')) AS anchor FROM (
    SELECT *, trim(regexp_extract(raw, '{LINK}', 1)) AS link, regexp_extract(raw, '{LINK}', 2) AS shown
    FROM l)))"""

PLACED_LINKS = f"""{SECTIONS}, {LINKS},
placed AS (
SELECT links.*, coalesce(sec.name, '---~--- incipit ---~---') AS section_name,
  coalesce(sec.level, 0) AS section_level, coalesce(sec.number, 0) AS section_number
FROM links ASOF LEFT JOIN sec ON links.page_id = sec.page_id AND links.rev_pos = sec.rev_pos
  AND links.b >= sec.b)"""


def ids(*kinds: str) -> str:
    """CTEs that end in ``ids(page_id, rev_pos, rev_id, type, id, b, e)``."""
    ctes, parts = [], []
    wanted = kinds or ("arxiv", "doi", "isbn", "pmid", "pmc")
    if "arxiv" in wanted:
        for n, pattern in enumerate(ARXIV):
            ctes.append(spans(f"arxiv{n}", pattern))
            parts.append(f"""
SELECT page_id, rev_pos, rev_id, 'arxiv' AS type, lower(id) AS id, b + lead AS b,
  CAST(b + lead + length(id) AS INTEGER) AS e FROM (
  SELECT *, regexp_extract(raw, '{pattern}', 3) || regexp_extract(raw, '{pattern}', 4) AS id,
    CAST(length(regexp_extract(raw, '{pattern}', 1)) + length(regexp_extract(raw, '{pattern}', 2)) AS INTEGER) AS lead
  FROM arxiv{n})""")
    if "doi" in wanted:
        ctes.append(spans("doi", DOI))
        parts.append("""
SELECT page_id, rev_pos, rev_id, 'doi' AS type, rtrim(raw, '.,!') AS id, b,
  CAST(b + length(rtrim(raw, '.,!')) AS INTEGER) AS e FROM doi WHERE b > 0""")
    for n, (kind, pattern) in enumerate(GROUP_IDS):
        if kind in wanted:
            ctes.append(spans(f"g{n}", pattern))
            parts.append(f"""
SELECT page_id, rev_pos, rev_id, '{kind}' AS type,
  {"replace(id, '-', '')" if kind == "isbn" else "id"} AS id, CAST(e - length(id) AS INTEGER) AS b, e
FROM (SELECT *, regexp_extract(raw, '{pattern}', 1) AS id FROM g{n})""")
    return ",\n".join(ctes) + ",\nids AS (" + " UNION ALL ".join(parts) + ")"


def _inside(table: str, condition: str = "true") -> str:
    return f"""EXISTS (SELECT 1 FROM {table} x WHERE x.page_id = ids.page_id AND x.rev_pos = ids.rev_pos
    AND x.b <= ids.b AND ids.e <= x.{'se' if table == 'allsec' else 'e'} AND {condition})"""


def located(condition: str = "true") -> str:
    """CTEs that end in ``loc``: identifiers with containment flags and appearance."""
    return f"""{ids()}, {spans('refs', REFERENCE)}, {spans('tpl', TEMPLATE)}, {SECTIONS}, {PREAMBLE},
flags AS (
SELECT *, {_inside('refs')} AS in_references, {_inside('tpl')} AS in_templates,
  {_inside('allsec', condition)} AS in_sections FROM ids),
loc AS (
SELECT *, CASE WHEN in_templates AND in_references THEN 'in_tag_ref_and_template'
  WHEN in_templates THEN 'only_in_template' WHEN in_references THEN 'only_in_tag_ref'
  WHEN in_sections THEN 'only_in_filtered_sections' ELSE 'only_in_raw_text' END AS appearance FROM flags)"""


IS_LOOSELY_BIBLIOGRAPHY = f"lower(trim(name)) IN ({BIBLIOGRAPHY_NAMES}, 'literature cited')"
IS_BIBLIOGRAPHY = f"lower(trim(name)) IN ({BIBLIOGRAPHY_NAMES})"
X_IS_BIBLIOGRAPHY = f"lower(trim(x.name)) IN ({BIBLIOGRAPHY_NAMES})"
FULL_BODY = "CASE WHEN level = 0 THEN body ELSE repeat('=', level) || name || repeat('=', level) || chr(10) || body END"

BIB_TEXT = f"""bib AS (
SELECT page_id, rev_pos, string_agg({FULL_BODY}, '' ORDER BY number) AS body, count(*) AS n
FROM sec WHERE {IS_BIBLIOGRAPHY} GROUP BY ALL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def span_rows(table: str) -> str:
    return f"SELECT page_id, rev_id, raw, b AS span_begin, e AS span_end FROM {table}"


ID_ROWS = "SELECT page_id, rev_id, type, id, b AS span_begin, e AS span_end FROM ids"


def section_rows(table: str) -> str:
    return f"""SELECT page_id, rev_id, number, name, level, md5(body) AS body_md5, b AS span_begin,
  se AS span_end FROM {table}"""


def scoped(columns: str, table: str) -> str:
    """Counts per ``columns`` in both scopes."""
    head = f"{columns}, " if columns else ""
    return f"""SELECT source_file, {head}'global' AS scope, count(*) AS count FROM {table} GROUP BY ALL
UNION ALL
SELECT source_file, {head}'last_revision' AS scope, count(*) AS count FROM {table} WHERE is_last GROUP BY ALL"""


def diffs(items: str, columns: str) -> str:
    """CTEs that end in ``d(page_id, rev_pos, action, <columns>)`` from presence ``items``."""
    same = " AND ".join(f"p.{c.strip()} = c.{c.strip()}" for c in columns.split(","))
    return f"""s AS ({items}), d AS (
SELECT page_id, rev_pos, 'added' AS action, {columns} FROM s c WHERE NOT EXISTS (
  SELECT 1 FROM s p WHERE p.page_id = c.page_id AND p.rev_pos = c.rev_pos - 1 AND {same})
UNION ALL
SELECT page_id, rev_pos + 1 AS rev_pos, 'removed' AS action, {columns} FROM s c WHERE NOT EXISTS (
  SELECT 1 FROM s p WHERE p.page_id = c.page_id AND p.rev_pos = c.rev_pos + 1 AND {same}))"""


DIFF_ROWS = """SELECT source_file, page_id, page_title, rev_id, user_id, user_name, ts, action, type, id
FROM d JOIN art USING (page_id, rev_pos)"""

# Section names and sizes need whole-line matching only; revisions without sections stay in.
NAMES = """named AS (
SELECT art.source_file, art.is_last, lower(trim(sec.name)) AS name FROM sec JOIN art USING (page_id, rev_pos))"""


def appearance_counts(condition: str) -> str:
    return (
        located(condition)
        + """,
classes(key) AS (VALUES ('only_in_raw_text'), ('only_in_tag_ref'), ('only_in_template'),
  ('in_tag_ref_and_template'), ('only_in_filtered_sections')),
scopes(scope) AS (VALUES ('global'), ('last_revision')),
files AS (SELECT DISTINCT source_file FROM art),
hits AS (SELECT art.source_file, art.is_last, loc.appearance FROM loc JOIN art USING (page_id, rev_pos))
SELECT f.source_file, s.scope, k.key, CAST(count(h.appearance) AS BIGINT) AS count
FROM files f CROSS JOIN scopes s CROSS JOIN classes k
LEFT JOIN hits h ON h.source_file = f.source_file AND h.appearance = k.key
  AND (s.scope = 'global' OR h.is_last)
GROUP BY ALL"""
    )


def wikilink_rows(where: str) -> str:
    return f"""SELECT source_file, page_id, page_title, art.rev_id AS revision_id, parent_id AS revision_parent_id,
  ts AS revision_timestamp,
  CASE WHEN user_name IS NULL THEN 'None' WHEN user_id IS NOT NULL THEN 'registered' ELSE 'ip' END AS user_type,
  coalesce(user_name, 'None') AS user_username,
  CASE WHEN user_name IS NULL THEN -2 WHEN user_id IS NOT NULL THEN user_id ELSE -1 END AS user_id,
  CAST(minor AS INTEGER) AS revision_minor, link AS wikilink_link, anchor AS wikilink_anchor,
  section_name AS wikilink_section_name, section_level AS wikilink_section_level,
  section_number AS wikilink_section_number
FROM placed JOIN art USING (page_id, rev_pos) WHERE {where}"""


ORACLE: dict[str, str] = {
    "page_ids": with_(REV)
    + "SELECT DISTINCT source_file, 'enwiki' AS project, page_id, page_title FROM rev WHERE ns = 0",
    "page_lookup": with_(REV)
    + "SELECT page_id, page_title, rev_pos, rev_id, parent_id FROM rev WHERE page_title = 'Page 7'",
    "last_revisions": with_(REV)
    + "SELECT source_file, page_id, rev_pos, rev_id, ts FROM rev WHERE ns = 0 AND is_last",
    "contributors": with_(REV)
    + """SELECT page_id, rev_id, parent_id,
  CASE WHEN user_name IS NULL THEN 'None' WHEN user_id IS NOT NULL THEN 'registered' ELSE 'ip' END AS user_type,
  coalesce(user_name, 'None') AS user_username,
  CASE WHEN user_name IS NULL THEN -2 WHEN user_id IS NOT NULL THEN user_id ELSE -1 END AS user_id,
  CAST(minor AS INTEGER) AS revision_minor, ts AS revision_timestamp FROM rev""",
    "strip_comments_pages": f"""
SELECT page_id, CAST(length(html) AS INTEGER) AS chars, CAST(length(s) AS INTEGER) AS stripped_chars,
  md5(s) AS stripped_md5
FROM (SELECT page_id, html, regexp_replace(html, '{COMMENT}', '', 'g') AS s FROM pages)""",
    "sections": with_(DOCS, SECTIONS) + section_rows("sec"),
    "sections_with_preamble": with_(ART, SECTIONS, PREAMBLE) + section_rows("allsec"),
    "section_full_body": with_(ART, SECTIONS, PREAMBLE)
    + f"SELECT page_id, rev_id, number, md5({FULL_BODY}) AS full_body_md5 FROM allsec",
    "references": with_(DOCS, spans("refs", REFERENCE)) + span_rows("refs"),
    "references_revisions": with_(ART, spans("refs", REFERENCE)) + span_rows("refs"),
    "templates": with_(DOCS, spans("tpl", TEMPLATE)) + span_rows("tpl"),
    "citation_templates": with_(ART, spans("cit", CITATION)) + span_rows("cit"),
    "ids_arxiv": with_(ART, ids("arxiv")) + ID_ROWS,
    "ids_doi": with_(ART, ids("doi")) + ID_ROWS,
    "ids_doi_all_starts": with_(DOCS, ids("doi")) + ID_ROWS,
    "ids_isbn": with_(ART, ids("isbn")) + ID_ROWS,
    "ids_pmid": with_(ART, ids("pmid")) + ID_ROWS,
    "ids_pmc": with_(ART, ids("pmc")) + ID_ROWS,
    "ids_all": with_(DOCS, ids()) + ID_ROWS,
    "ids_chosen_extractors": with_(DOCS, spans("own", "src[0-9]+"), ids("pmid"))
    + ID_ROWS
    + " UNION ALL SELECT page_id, rev_id, 'source', raw, b, e FROM own",
    "links": with_(DOCS, LINKS)
    + "SELECT page_id, rev_id, link, anchor, b AS span_begin, e AS span_end FROM links",
    "links_sectioned": with_(DOCS, PLACED_LINKS)
    + """SELECT page_id, link, anchor, b AS span_begin, section_name, section_level, section_number
FROM placed""",
    "identifier_containment": with_(DOCS, located())
    + """SELECT page_id, type, id, b AS span_begin, in_references, in_templates, in_sections, appearance
FROM loc""",
    "identifiers_in_sections": with_(ART, located(X_IS_BIBLIOGRAPHY))
    + "SELECT page_id, rev_id, type, id, b AS span_begin FROM loc WHERE in_sections",
    "bibliography_sections": with_(DOCS, SECTIONS)
    + f"SELECT page_id, number, name, level FROM sec WHERE {IS_BIBLIOGRAPHY}",
    "bibliography_sections_loose": with_(DOCS, SECTIONS)
    + f"SELECT page_id, number, name, level FROM sec WHERE {IS_LOOSELY_BIBLIOGRAPHY}",
    "extract_wikilinks": with_(ART, PLACED_LINKS) + wikilink_rows("true"),
    "extract_wikilinks_last": with_(ART, PLACED_LINKS) + wikilink_rows("is_last"),
    "bibliography_text": with_(ART, SECTIONS, BIB_TEXT)
    + """SELECT source_file, page_id, rev_id, is_last, md5(coalesce(body, '')) AS text_md5,
  CAST(length(coalesce(body, '')) AS INTEGER) AS text_chars, coalesce(n, 0) AS sections
FROM art LEFT JOIN bib USING (page_id, rev_pos)""",
    "bibliography_name_counts": with_(
        ART,
        SECTIONS,
        f"""bn AS (SELECT source_file, is_last, name FROM sec JOIN art USING (page_id, rev_pos)
WHERE {IS_BIBLIOGRAPHY})""",
    )
    + scoped("name", "bn"),
    "section_name_counts": with_(ART, SECTIONS, NAMES) + scoped("name", "named"),
    "section_name_counts_articles": with_(DOCS, SECTIONS, NAMES) + scoped("name", "named"),
    "sections_per_revision": with_(
        ART,
        SECTIONS,
        """sized AS (SELECT art.source_file, art.is_last,
  (SELECT CAST(count(*) AS INTEGER) FROM sec WHERE sec.page_id = art.page_id AND sec.rev_pos = art.rev_pos) AS sections
FROM art)""",
    )
    + scoped("sections", "sized"),
    "revision_counts": with_(ART) + scoped("", "art"),
    "job_counters": with_(ART)
    + """SELECT source_file, count(DISTINCT page_id) AS pages_analyzed, count(*) AS revisions_analyzed
FROM art GROUP BY ALL""",
    "identifier_appearances": with_(ART, appearance_counts("true")),
    "identifier_appearances_articles": with_(DOCS, appearance_counts(X_IS_BIBLIOGRAPHY)),
    "identifier_diffs": with_(
        ART, ids(), diffs("SELECT DISTINCT page_id, rev_pos, type, id FROM ids", "type, id")
    )
    + DIFF_ROWS,
    "identifier_diffs_bibliography": with_(
        ART,
        located(X_IS_BIBLIOGRAPHY),
        diffs(
            "SELECT DISTINCT page_id, rev_pos, type, id FROM loc WHERE in_sections", "type, id"
        ),
    )
    + DIFF_ROWS,
    "identifier_diffs_last": with_(ART, ids())
    + """SELECT DISTINCT source_file, page_id, page_title, rev_id, user_id, user_name, ts,
  'added' AS action, type, id FROM ids JOIN art USING (page_id, rev_pos, rev_id) WHERE is_last""",
    "identifier_lifespans": with_(ART, ids())
    + """, ranked AS (
SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ts, rev_id) AS n FROM art),
present AS (
SELECT DISTINCT source_file, page_id, page_title, type, id, n FROM ids JOIN ranked USING (page_id, rev_pos)),
islands AS (
SELECT source_file, page_id, page_title, type, id, min(n) AS first_n, max(n) AS last_n FROM (
  SELECT *, n - row_number() OVER (PARTITION BY page_id, type, id ORDER BY n) AS island FROM present)
GROUP BY source_file, page_id, page_title, type, id, island)
SELECT i.source_file, 'enwiki' AS project, i.page_id, i.page_title, i.type AS identifier_type,
  i.id AS identifier_id, a.ts AS added_ts, r.ts AS removed_ts
FROM islands i JOIN ranked a ON a.page_id = i.page_id AND a.n = i.first_n
LEFT JOIN ranked r ON r.page_id = i.page_id AND r.n = i.last_n + 1""",
    "reference_diffs": with_(
        ART,
        spans("refs", REFERENCE),
        diffs("SELECT DISTINCT page_id, rev_pos, raw FROM refs", "raw"),
    )
    + "SELECT source_file, page_id, rev_id, action, raw AS reference FROM d JOIN art USING (page_id, rev_pos)",
    "revision_report_rows": with_(
        ART,
        spans("refs", REFERENCE),
        "rd AS ("
        + with_(diffs("SELECT DISTINCT page_id, rev_pos, raw FROM refs", "raw"))
        + "SELECT page_id, rev_pos, count(*) AS n, md5(string_agg(action || ':' || raw, chr(10)"
        " ORDER BY action || ':' || raw)) AS h FROM d GROUP BY ALL)",
        ids(),
        "idd AS ("
        + with_(diffs("SELECT DISTINCT page_id, rev_pos, type, id FROM ids", "type, id"))
        + "SELECT page_id, rev_pos, count(*) AS n, md5(string_agg(action || ':' || type || ':' || id, chr(10)"
        " ORDER BY action || ':' || type || ':' || id)) AS h FROM d GROUP BY ALL)",
        SECTIONS,
        BIB_TEXT,
        "ns AS (SELECT page_id, rev_pos, count(*) AS n, md5(string_agg(CAST(level AS VARCHAR) || ':' || name,"
        " chr(10) ORDER BY number)) AS h FROM sec GROUP BY ALL)",
    )
    + """SELECT source_file, page_id, art.rev_id, coalesce(rd.n, 0) AS reference_changes,
  coalesce(idd.n, 0) AS identifier_changes, coalesce(ns.n, 0) AS sections,
  coalesce(rd.h, md5('')) AS reference_changes_md5, coalesce(idd.h, md5('')) AS identifier_changes_md5,
  coalesce(ns.h, md5('')) AS sections_md5,
  md5(coalesce(bib.body, '')) AS bibliography_md5
FROM art LEFT JOIN rd USING (page_id, rev_pos) LEFT JOIN idd USING (page_id, rev_pos)
LEFT JOIN ns USING (page_id, rev_pos) LEFT JOIN bib USING (page_id, rev_pos)""",
    "grand_totals": with_(
        ART,
        SECTIONS,
        NAMES,
        """sized AS (SELECT art.is_last, CAST(count(sec.number) AS VARCHAR) AS n
FROM art LEFT JOIN sec ON sec.page_id = art.page_id AND sec.rev_pos = art.rev_pos
GROUP BY art.page_id, art.rev_pos, art.is_last),
items AS (
SELECT 'section-names-per-revision' AS counter, name AS key, is_last FROM named
UNION ALL SELECT 'sections-per-revision', n, is_last FROM sized
UNION ALL SELECT 'revisions', NULL, is_last FROM art)""",
    )
    + """SELECT counter, 'global' AS scope, key, count(*) AS count FROM items GROUP BY ALL
UNION ALL
SELECT counter, 'last_revision' AS scope, key, count(*) AS count FROM items WHERE is_last GROUP BY ALL""",
    "bibliography_document_read_back": with_(ART, SECTIONS, BIB_TEXT)
    + """SELECT page_id, page_title, ns, rev_pos, rev_id, parent_id, ts,
  CASE WHEN user_name IS NULL THEN 'None' WHEN user_id IS NOT NULL THEN 'registered' ELSE 'ip' END AS user_type,
  coalesce(user_name, 'None') AS user_username,
  CASE WHEN user_name IS NULL THEN -2 WHEN user_id IS NOT NULL THEN user_id ELSE -1 END AS user_id,
  CAST(minor AS INTEGER) AS minor, comment, model, format, md5(coalesce(body, '')) AS text_md5, is_last
FROM art LEFT JOIN bib USING (page_id, rev_pos)""",
    "revision_edges": with_(REV) + "SELECT source_file, page_id, parent_id, rev_id, ts FROM rev",
    "dangling_parents": with_(REV)
    + """SELECT source_file, page_id, parent_id, rev_id, ts FROM rev WHERE parent_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM rev p WHERE p.page_id = rev.page_id AND p.rev_id = rev.parent_id)""",
    "duplicate_ids": with_(REV)
    + """SELECT 'page' AS kind, source_file, page_id AS id, count(*) AS n FROM rev WHERE rev_pos = 0
GROUP BY ALL HAVING count(*) > 1
UNION ALL
SELECT 'revision' AS kind, source_file, rev_id AS id, count(*) AS n FROM rev GROUP BY ALL HAVING count(*) > 1""",
    "constraint_violations": with_(REV)
    + """SELECT source_file, page_id, rev_id, rule, value FROM (
SELECT *, 'ns_not_negative' AS rule, CAST(ns AS VARCHAR) AS value, ns < 0 AS broken FROM rev
UNION ALL SELECT *, 'page_id_positive', CAST(page_id AS VARCHAR), page_id <= 0 FROM rev
UNION ALL SELECT *, 'rev_id_positive', CAST(rev_id AS VARCHAR), rev_id <= 0 FROM rev
UNION ALL SELECT *, 'parent_id_positive', CAST(parent_id AS VARCHAR), parent_id <= 0 FROM rev
UNION ALL SELECT *, 'title_present', page_title, page_title IS NULL FROM rev
UNION ALL SELECT *, 'timestamp_present', ts, ts IS NULL FROM rev
UNION ALL SELECT *, 'model_pattern', model, NOT regexp_full_match(model, '[a-zA-Z][-+./a-zA-Z0-9]*') FROM rev
UNION ALL SELECT *, 'format_pattern', format,
  NOT regexp_full_match(format, '[a-zA-Z][-+.a-zA-Z0-9]*/[a-zA-Z][-+.a-zA-Z0-9]*') FROM rev)
WHERE broken""",
}

ORACLE["lifespans_csv_read_back"] = ORACLE["identifier_lifespans"]
ORACLE["extract_wikilinks_last_unflagged"] = ORACLE["extract_wikilinks_last"]
ORACLE["wikilinks_csv_read_back"] = ORACLE["extract_wikilinks"]


def of_twins(sql: str) -> str:
    """The same rows where every second page has the id of another."""
    return f"SELECT * REPLACE (page_id - CASE WHEN page_id % 6 >= 3 THEN 3 ELSE 0 END AS page_id) FROM ({sql})"


ORACLE["identifier_diffs_twin_pages"] = of_twins(ORACLE["identifier_diffs"])
ORACLE["identifier_lifespans_twin_pages"] = of_twins(ORACLE["identifier_lifespans"])
ORACLE["bibliography_document_twin_pages"] = (
    with_(ART)
    + """SELECT source_file, CAST(0 AS BIGINT) AS least_open,
  CAST(CASE WHEN count(*) > count(DISTINCT page_id) THEN 1 ELSE 0 END AS BIGINT) AS most_open,
  count(DISTINCT page_id) AS pages, count(*) AS revisions FROM art GROUP BY source_file"""
)
