"""Plan shapes that matter on large data."""

import re

import pytest
from conftest import SMALL

from palimpsest.checks.queries import QUERIES
from palimpsest.operators.revisions import last_revisions, likely_last
from palimpsest.plans import identifiers, sections_counter, wikilinks
from palimpsest.session import staged
from palimpsest.sources.tables import conversation_revisions, spread

NODE = re.compile(
    r"\n[ :+*\-]*(?:\*?\(\d+\) )?(?=(?:Project|Filter|Generate|Window|HashAggregate|Sort|Exchange"
    r"|FileScan|BroadcastExchange|BroadcastHashJoin|SortMergeJoin)\b)"
)


def nodes(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return NODE.split(plan)


@pytest.mark.parametrize(
    "name",
    [
        "identifier_appearances_articles",
        "identifier_diffs",
        "identifier_lifespans",
        "bibliography_name_counts",
        "section_name_counts",
        "revision_report_rows",
        "links_sectioned",
        "identifier_containment",
    ],
)
def test_texts_are_read_once(spark, name):
    """One node extracts from the text: nothing is evaluated again in a filter."""
    assert len([n for n in nodes(spark, name) if "regexp_extract_all(" in n]) == 1


@pytest.mark.parametrize(
    "name",
    sorted(
        name
        for name, function in QUERIES.items()
        if function.__module__ == "palimpsest.checks.queries" and name != "bibliography_document_read_back"
    ),
)
def test_no_python_and_no_pairs(spark, name):
    plan = "\n".join(nodes(spark, name))
    for operator in ("ArrowEvalPython", "BatchEvalPython", "InPandas", "InArrow",
                     "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["extract_wikilinks", "links_sectioned", "sections", "ids_all"])
def test_extraction_does_not_shuffle(spark, name):
    """Only the spreading of the small input is an exchange."""
    exchanges = [n for n in nodes(spark, name) if n.startswith("Exchange")]
    assert all("REPARTITION_BY_NUM" in n for n in exchanges)


def test_history_shuffles_by_page_and_block(spark):
    keyed = [n for n in nodes(spark, "identifier_diffs") if n.startswith("Exchange hash")]
    shuffles = [n for n in keyed if "REPARTITION_BY_NUM" not in n]
    assert len(shuffles) == 1
    assert re.search(r"source_file#\d+, page_id#\d+L, block#\d+", shuffles[0])


def outputs_of_exchanges(plan):
    found = [plan.output().mkString(" ")] if "Exchange" in plan.nodeName() else []
    children = plan.children()
    for i in range(children.size()):
        found += outputs_of_exchanges(children.apply(i))
    return found


def test_last_revisions_are_found_without_moving_texts(spark):
    revisions = staged(conversation_revisions(spark, SMALL), "unflagged")
    plans = (
        identifiers.captured(revisions, only_last=True),
        sections_counter.captured(revisions, only_last=True),
        wikilinks.features(revisions, "en", only_last=True),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rows in plans:
            moved = outputs_of_exchanges(rows._jdf.queryExecution().executedPlan())
            assert moved and not any(re.search(r"\btext#", columns) for columns in moved)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("bits", [1 << 15, 1 << 16, 1 << 26])
def test_likely_last_revisions_hold_the_last_ones(spark, bits):
    revisions = staged(conversation_revisions(spark, SMALL).drop("text"), "unflagged")
    last = {(r.page_id, r.rev_pos) for r in last_revisions(revisions).collect()}
    likely = {(r.page_id, r.rev_pos) for r in likely_last(revisions, bits).collect()}
    assert last <= likely and len(likely) < revisions.count()
    assert likely_last(revisions.limit(0), bits).collect() == []


def test_one_row_group_is_dealt_to_all_cores(spark, tmp_path):
    """Read tasks are cut by bytes, so most of these get no rows."""
    path = str(tmp_path / "documents.parquet")
    rows = spark.range(400).selectExpr("id AS doc_id", "repeat(md5(string(id)), 50) AS text")
    rows.coalesce(1).write.option("compression", "uncompressed").parquet(path)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() >= cores
        sizes = spread(table, "doc_id").rdd.glom().map(len).collect()
        assert sum(sizes) == 400 and sum(1 for size in sizes if size) >= cores
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
