"""The registered queries: ``name -> f(spark, directory) -> DataFrame``.

All of them read whole tables and whole texts.  Columns are flat scalars.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions import identifiers as ids
from palimpsest.functions import wikitext
from palimpsest.functions.matching import is_bibliography
from palimpsest.functions.text import strip_comments
from palimpsest.operators import counts, history, quality, relate
from palimpsest.operators import revisions as rev
from palimpsest.plans import (
    bibliography,
    identifiers,
    identifiers_history,
    page_ids,
    revision_report,
    sections_counter,
    wikilinks,
)
from palimpsest.session import staged, working_folder
from palimpsest.sinks import documents, tables
from palimpsest.sources import xml_dump
from palimpsest.sources.tables import conversation_revisions, document_articles, web_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _conversations(spark: SparkSession, directory: str) -> DataFrame:
    """Article revisions with clean text."""
    return rev.with_clean_text(rev.articles(conversation_revisions(spark, directory)))


def _documents(spark: SparkSession, directory: str) -> DataFrame:
    return rev.with_clean_text(rev.articles(document_articles(spark, directory)))


def _captures(rows: DataFrame, captures: Column) -> DataFrame:
    return rows.select("page_id", "rev_id", F.inline(captures))


def _span_rows(rows: DataFrame, captures: Column) -> DataFrame:
    return _captures(rows, captures).select(
        "page_id", "rev_id", "raw", F.col("begin").alias("span_begin"), F.col("end").alias("span_end")
    )


def _id_rows(rows: DataFrame, captures: Column) -> DataFrame:
    return _captures(rows, captures).select(
        "page_id",
        "rev_id",
        "type",
        "id",
        F.col("begin").alias("span_begin"),
        F.col("end").alias("span_end"),
    )


def _section_rows(rows: DataFrame, captures: Column) -> DataFrame:
    return _captures(rows, captures).select(
        "page_id",
        "rev_id",
        "number",
        "name",
        "level",
        F.md5("body").alias("body_md5"),
        F.col("begin").alias("span_begin"),
        F.col("end").alias("span_end"),
    )



# -- pages and revisions ---------------------------------------------------------------


@query
def page_ids_query(spark, directory):
    return page_ids.features(conversation_revisions(spark, directory), "enwiki")


@query
def page_lookup(spark, directory):
    found = rev.find_page(conversation_revisions(spark, directory), "Page 7")
    return found.select("page_id", "page_title", "rev_pos", "rev_id", "parent_id")


@query
def last_revisions(spark, directory):
    revisions = conversation_revisions(spark, directory, last_flag=True)
    return rev.last_revisions(rev.articles(revisions)).select(
        "source_file", "page_id", "rev_pos", "rev_id", rev.iso_timestamp(F.col("ts")).alias("ts")
    )


@query
def contributors(spark, directory):
    return conversation_revisions(spark, directory).select(
        "page_id",
        "rev_id",
        "parent_id",
        *rev.contributor(F.col("user")),
        rev.minor_flag(F.col("minor")).alias("revision_minor"),
        rev.iso_timestamp(F.col("ts")).alias("revision_timestamp"),
    )


# -- captures --------------------------------------------------------------------------


@query
def strip_comments_pages(spark, directory):
    pages = web_pages(spark, directory)
    stripped = strip_comments(F.col("html"))
    return pages.select("page_id", F.length("html").alias("chars"), stripped.alias("stripped")).select(
        "page_id",
        "chars",
        F.length("stripped").alias("stripped_chars"),
        F.md5("stripped").alias("stripped_md5"),
    )


@query
def sections(spark, directory):
    return _section_rows(_documents(spark, directory), wikitext.sections(F.col("text")))


@query
def sections_with_preamble(spark, directory):
    return _section_rows(
        _conversations(spark, directory), wikitext.sections(F.col("text"), include_preamble=True)
    )


@query
def section_full_body(spark, directory):
    bodies = F.transform(
        wikitext.sections(F.col("text"), include_preamble=True),
        lambda s: F.struct(s["number"].alias("number"), wikitext.full_body(s).alias("full_body")),
    )
    return _captures(_conversations(spark, directory), bodies).select(
        "page_id", "rev_id", "number", F.md5("full_body").alias("full_body_md5")
    )


@query
def references(spark, directory):
    return _span_rows(_documents(spark, directory), wikitext.references(F.col("text")))


@query
def references_revisions(spark, directory):
    return _span_rows(_conversations(spark, directory), wikitext.references(F.col("text")))


@query
def templates(spark, directory):
    return _span_rows(_documents(spark, directory), wikitext.templates(F.col("text")))


@query
def citation_templates(spark, directory):
    return _span_rows(_conversations(spark, directory), wikitext.citations(F.col("text"), "en"))


@query
def ids_arxiv(spark, directory):
    return _id_rows(_conversations(spark, directory), ids.arxiv(F.col("text")))


@query
def ids_doi(spark, directory):
    return _id_rows(_conversations(spark, directory), ids.doi(F.col("text")))


@query
def ids_doi_all_starts(spark, directory):
    return _id_rows(_documents(spark, directory), ids.doi(F.col("text"), overlap="all"))


@query
def ids_isbn(spark, directory):
    return _id_rows(_conversations(spark, directory), ids.isbn(F.col("text")))


@query
def ids_pmid(spark, directory):
    return _id_rows(_conversations(spark, directory), ids.pmid(F.col("text")))


@query
def ids_pmc(spark, directory):
    return _id_rows(_conversations(spark, directory), ids.pmc(F.col("text")))


@query
def ids_all(spark, directory):
    return _id_rows(_documents(spark, directory), ids.publication_identifiers(F.col("text")))


@query
def ids_chosen_extractors(spark, directory):
    """A caller's own extractor next to a built-in one."""
    from palimpsest.functions.text import locate_all

    def issn(text: Column) -> Column:
        return F.transform(
            locate_all(text, r"src[0-9]+"),
            lambda m: F.struct(
                F.lit("source").alias("type"),
                m["raw"].alias("id"),
                m["begin"].alias("begin"),
                m["end"].alias("end"),
            ),
        )

    return _id_rows(
        _documents(spark, directory),
        ids.publication_identifiers(F.col("text"), [issn, ids.pmid]),
    )


@query
def links(spark, directory):
    return _captures(_documents(spark, directory), wikitext.wikilinks(F.col("text"))).select(
        "page_id",
        "rev_id",
        "link",
        "anchor",
        F.col("begin").alias("span_begin"),
        F.col("end").alias("span_end"),
    )


# -- relations -------------------------------------------------------------------------


@query
def links_sectioned(spark, directory):
    return _captures(
        _documents(spark, directory), wikitext.sectioned_wikilinks(F.col("text"))
    ).select(
        "page_id",
        "link",
        "anchor",
        F.col("begin").alias("span_begin"),
        "section_name",
        "section_level",
        "section_number",
    )


@query
def identifier_containment(spark, directory):
    return _captures(
        _documents(spark, directory), relate.located_identifiers(F.col("text"))
    ).select(
        "page_id",
        "type",
        "id",
        F.col("begin").alias("span_begin"),
        "in_references",
        "in_templates",
        "in_sections",
        "appearance",
    )


@query
def identifiers_in_sections(spark, directory):
    keep = relate.section_filter("bibliography", "en")
    located = relate.located_identifiers(F.col("text"), keep)
    return (
        _captures(_conversations(spark, directory), located)
        .where("in_sections")
        .select("page_id", "rev_id", "type", "id", F.col("begin").alias("span_begin"))
    )


@query
def bibliography_sections(spark, directory):
    kept = F.filter(
        wikitext.sections(F.col("text")), lambda s: is_bibliography(s["name"], "en")
    )
    return _captures(_documents(spark, directory), kept).select(
        "page_id", "number", "name", "level"
    )


@query
def bibliography_sections_loose(spark, directory):
    """Windows of longer names count here: ``Literature cited`` holds a term."""
    kept = F.filter(
        wikitext.sections(F.col("text")), lambda s: is_bibliography(s["name"], "en", 70)
    )
    return _captures(_documents(spark, directory), kept).select(
        "page_id", "number", "name", "level"
    )


# -- jobs ------------------------------------------------------------------------------


@query
def extract_wikilinks(spark, directory):
    return wikilinks.features(conversation_revisions(spark, directory), "en")


@query
def extract_wikilinks_last(spark, directory):
    revisions = conversation_revisions(spark, directory, last_flag=True)
    return wikilinks.features(revisions, "en", only_last=True)


@query
def extract_wikilinks_last_unflagged(spark, directory):
    """The same where the source does not tell which revisions are the last."""
    return wikilinks.features(conversation_revisions(spark, directory), "en", only_last=True)


@query
def bibliography_text(spark, directory):
    captured = bibliography.captured(conversation_revisions(spark, directory), "en")
    return captured.select(
        "source_file",
        "page_id",
        "rev_id",
        "is_last",
        F.md5("text").alias("text_md5"),
        F.length("text").alias("text_chars"),
        F.size("sections").cast("bigint").alias("sections"),
    )


@query
def bibliography_name_counts(spark, directory):
    captured = bibliography.captured(conversation_revisions(spark, directory), "en")
    return bibliography.name_counts(captured)


@query
def section_name_counts(spark, directory):
    return sections_counter.name_counts(
        sections_counter.captured(conversation_revisions(spark, directory))
    )


@query
def section_name_counts_articles(spark, directory):
    return sections_counter.name_counts(
        sections_counter.captured(document_articles(spark, directory))
    )


@query
def sections_per_revision(spark, directory):
    return sections_counter.section_counts(
        sections_counter.captured(conversation_revisions(spark, directory))
    )


@query
def revision_counts(spark, directory):
    return sections_counter.revision_counts(
        sections_counter.captured(conversation_revisions(spark, directory))
    )


@query
def job_counters(spark, directory):
    captured = sections_counter.captured(conversation_revisions(spark, directory))
    return counts.analyzed(captured)


@query
def identifier_appearances(spark, directory):
    return identifiers.appearance_counts(
        identifiers.captured(conversation_revisions(spark, directory))
    )


@query
def identifier_appearances_articles(spark, directory):
    keep = relate.section_filter("bibliography", "en")
    return identifiers.appearance_counts(
        identifiers.captured(document_articles(spark, directory), keep)
    )


def _diff_rows(captured: DataFrame, only_last: bool = False) -> DataFrame:
    return identifiers.diffs(identifiers.features(captured, only_last)).select(
        "source_file",
        "page_id",
        "page_title",
        "rev_id",
        F.col("user.id").alias("user_id"),
        F.col("user.text").alias("user_name"),
        rev.iso_timestamp(F.col("ts")).alias("ts"),
        "action",
        "type",
        "id",
    )


@query
def identifier_diffs(spark, directory):
    return _diff_rows(identifiers.captured(conversation_revisions(spark, directory)))


@query
def identifier_diffs_bibliography(spark, directory):
    keep = relate.section_filter("bibliography", "en")
    return _diff_rows(identifiers.captured(conversation_revisions(spark, directory), keep))


@query
def identifier_diffs_last(spark, directory):
    revisions = conversation_revisions(spark, directory, last_flag=True)
    return _diff_rows(identifiers.captured(revisions, only_last=True), only_last=True)


@query
def identifier_lifespans(spark, directory):
    spans = identifiers_history.features(conversation_revisions(spark, directory), "enwiki")
    return spans.withColumn("added_ts", rev.iso_timestamp(F.col("added_ts"))).withColumn(
        "removed_ts", rev.iso_timestamp(F.col("removed_ts"))
    )


def _twin_pages(spark, directory):
    """Pages of which two have one id: told apart by their place in the file."""
    revisions = conversation_revisions(spark, directory)
    place = F.struct(F.lit(0).cast("bigint").alias("split"), F.col("page_id").alias("record"))
    twin = F.col("page_id") - F.when(F.col("page_id") % 6 >= 3, 3).otherwise(0)
    return revisions.withColumn("page_ordinal", place).withColumn("page_id", twin)


@query
def identifier_diffs_twin_pages(spark, directory):
    return _diff_rows(identifiers.captured(_twin_pages(spark, directory)))


@query
def identifier_lifespans_twin_pages(spark, directory):
    spans = identifiers_history.features(_twin_pages(spark, directory), "enwiki")
    return spans.withColumn("added_ts", rev.iso_timestamp(F.col("added_ts"))).withColumn(
        "removed_ts", rev.iso_timestamp(F.col("removed_ts"))
    )


@query
def bibliography_document_twin_pages(spark, directory):
    """Pages of one id are well-formed documents of their own."""
    fragments = documents.bibliography_document(bibliography.captured(_twin_pages(spark, directory), "en"))
    in_order = Window.partitionBy("source_file").orderBy(*documents.KEYS)
    tags = F.regexp_count("fragment", F.lit("<page>")) - F.regexp_count("fragment", F.lit("</page>"))
    opened = fragments.where(F.col("place") == documents.BODY).withColumn("opened", F.sum(tags).over(in_order))
    return opened.groupBy("source_file").agg(
        F.min("opened").alias("least_open"), F.max("opened").alias("most_open"),
        F.sum(F.regexp_count("fragment", F.lit("<page>"))).alias("pages"),
        F.count(F.lit(1)).alias("revisions"),
    )


@query
def reference_diffs(spark, directory):
    rows = _conversations(spark, directory)
    texts = F.array_distinct(F.transform(wikitext.references(F.col("text")), lambda r: r["raw"]))
    narrow = rows.select("source_file", "page_id", "rev_pos", "rev_id", texts.alias("texts"))
    changed = history.with_changes(narrow, "texts")
    return history.one_per_change(changed, "source_file", "page_id", "rev_id").withColumnRenamed(
        "item", "reference"
    )


def _changes_md5(changes: str) -> Column:
    items = F.transform(changes, lambda c: F.concat(c["action"], F.lit(":"), c["item"]))
    return F.md5(F.array_join(F.sort_array(items), "\n"))


@query
def revision_report_rows(spark, directory):
    report = revision_report.features(conversation_revisions(spark, directory), "en")
    return report.select(
        "source_file",
        "page_id",
        "rev_id",
        F.size("references_diff").cast("bigint").alias("reference_changes"),
        _changes_md5("references_diff").alias("reference_changes_md5"),
        F.size("identifiers_diff").cast("bigint").alias("identifier_changes"),
        _changes_md5("identifiers_diff").alias("identifier_changes_md5"),
        F.size("sections").cast("bigint").alias("sections"),
        F.md5(
            F.array_join(
                F.transform("sections", lambda s: F.concat(s["level"].cast("string"), F.lit(":"), s["name"])), "\n"
            )
        ).alias("sections_md5"),
        F.md5("bibliography").alias("bibliography_md5"),
    )


@query
def grand_totals(spark, directory):
    captured = staged(sections_counter.captured(conversation_revisions(spark, directory)), "sections")
    return counts.grand_total(sections_counter.stats(captured))


# -- outputs, read back ----------------------------------------------------------------


def _output(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def bibliography_document_read_back(spark, directory):
    """The bibliography job's document, read as a dump."""
    path = _output(spark, "bibliography-document")
    captured = staged(bibliography.captured(conversation_revisions(spark, directory), "en"), "bibliography")
    documents.write_document(documents.bibliography_document(captured), documents.KEYS, path)
    return xml_dump.read_revisions(spark, path).select(
        "page_id",
        "page_title",
        "ns",
        "rev_pos",
        "rev_id",
        "parent_id",
        rev.iso_timestamp(F.col("ts")).alias("ts"),
        *rev.contributor(F.col("user")),
        rev.minor_flag(F.col("minor")).alias("minor"),
        "comment",
        "model",
        "format",
        F.md5("text").alias("text_md5"),
        "is_last",
    )


@query
def lifespans_csv_read_back(spark, directory):
    path = _output(spark, "lifespans-csv")
    spans = identifiers_history.features(conversation_revisions(spark, directory), "enwiki")
    tables.write_lifespans(spans, path)
    schema = (
        "project string, page_id bigint, page_title string, identifier_type string,"
        " identifier_id string, added_ts string, removed_ts string, source_file string"
    )
    return spark.read.schema(schema).csv(path)


@query
def wikilinks_csv_read_back(spark, directory):
    path = _output(spark, "wikilinks-csv")
    tables.write_wikilinks(
        wikilinks.features(conversation_revisions(spark, directory), "en"), path
    )
    schema = (
        "page_id bigint, page_title string, revision_id bigint, revision_parent_id bigint,"
        " revision_timestamp string, user_type string, user_username string, user_id bigint,"
        " revision_minor int, wikilink_link string, wikilink_anchor string,"
        " wikilink_section_name string, wikilink_section_level int, wikilink_section_number int,"
        " source_file string"
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )


# -- graph and integrity ---------------------------------------------------------------


@query
def revision_edges(spark, directory):
    edges = quality.revision_edges(conversation_revisions(spark, directory))
    return edges.withColumn("ts", rev.iso_timestamp(F.col("ts")))


@query
def dangling_parents(spark, directory):
    edges = quality.dangling_parents(conversation_revisions(spark, directory))
    return edges.withColumn("ts", rev.iso_timestamp(F.col("ts")))


@query
def duplicate_ids(spark, directory):
    return quality.duplicate_ids(conversation_revisions(spark, directory))


@query
def constraint_violations(spark, directory):
    return quality.constraint_violations(conversation_revisions(spark, directory))


# The job module has this name, so its query function could not.
QUERIES["page_ids"] = QUERIES.pop("page_ids_query")
