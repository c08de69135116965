"""Reading dumps, running the jobs and reading their outputs back."""

import csv
import gzip
import xml.etree.ElementTree as ET
from pathlib import Path
from urllib.parse import unquote

import dumps
import pytest
from pyspark.sql import functions as F

from palimpsest.model import REVISIONS
from palimpsest.operators import quality
from palimpsest.operators.revisions import articles, find_page, with_last_flag
from palimpsest.plans import identifiers, identifiers_history, jobs, revision_report
from palimpsest.sinks import documents
from palimpsest.sources import xml_dump
from palimpsest.streaming.revisions import append_wikilinks, revision_stream

COLUMNS = REVISIONS.fieldNames()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    for name in ("one.xml", "two.xml"):
        (folder / name).write_text(dumps.sample(), encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def whole(spark, folder):
    return xml_dump.read_whole_pages(spark, folder).cache()


def rows(frame):
    return sorted(map(repr, frame.select(*COLUMNS).collect()))


def document(folder):
    """The part files of one source, in name order, as one text."""
    (source,) = [d for d in Path(folder).iterdir() if unquote(d.name).endswith("one.xml")]
    text = ""
    for part in sorted(source.glob("part-*")):
        data = part.read_bytes()
        text += (gzip.decompress(data) if part.suffix == ".gz" else data).decode("utf-8")
    return text


def table(folder):
    return list(csv.reader(document(folder).splitlines(keepends=True)))


def test_whole_pages(whole):
    first = whole.where("page_id = 1 AND source_file LIKE '%one.xml'").orderBy("rev_pos").collect()
    assert [(r.rev_id, r.parent_id, r.minor, r.is_last, r.chrono_pos) for r in first] == [
        (11, None, True, False, 1), (12, 11, False, False, 0), (13, 12, False, True, 2)
    ]
    assert [r.user for r in first] == [(7, "Ann <1>"), (None, "10.0.0.1"), None]
    assert first[0].text.startswith("  doi=10.1000/x lead\n== References ==\n<ref>b</ref>")
    assert first[1].text == "[[a|b]] </page><page> </revision>\n= S =\n[[c]]"
    assert first[1].comment == "c > d" and first[2].text == ""
    assert first[0].page_title == "First & only"


def test_revision_records_agree_with_whole_pages(spark, folder, whole):
    assert rows(xml_dump.read_revisions(spark, folder)) == rows(whole)


@pytest.mark.parametrize("split_bytes", [400, 1500, 9000])
def test_small_splits(spark, folder, whole, split_bytes):
    names = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    for name, value in zip(names, (split_bytes, 1, 200)):
        spark.conf.set(f"spark.sql.files.{name}", str(value))
    try:
        split = xml_dump.read_revisions(spark, folder)
        assert split.rdd.getNumPartitions() > 2
        assert rows(split) == rows(whole)
        assert rows(xml_dump.read_whole_pages(spark, folder)) == rows(whole)
        assert xml_dump.read_siteinfo(spark, folder).count() == 2
        assert xml_dump.read_pages(spark, folder).count() == 8
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("records, split_bytes", [(1, 3000), (3, 3000), (7, 10**8)])
def test_small_batches(spark, folder, whole, records, split_bytes):
    """Page heads are also carried from one Arrow batch to the next."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, str(records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        assert rows(xml_dump.read_revisions(spark, folder)) == rows(whole)
    finally:
        spark.conf.unset(batch)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture(scope="module")
def twins(tmp_path_factory):
    """Two pages of one id, and a third, in a file of their own."""
    folder = tmp_path_factory.mktemp("twins")
    one = [dumps.revision(11, "2015-01-01T00:00:00Z", "doi=10.1000/a"), dumps.revision(12, "2015-01-03T00:00:00Z", "doi=10.1000/a doi=10.1000/b")]
    two = [dumps.revision(21, "2015-01-02T00:00:00Z", "doi=10.1000/c"), dumps.revision(22, "2015-01-04T00:00:00Z", "no more")]
    pages = [dumps.page(7, "A", 0, one), dumps.page(8, "Between", 0, [dumps.revision(31, "2015-01-01T00:00:00Z", "doi=10.1000/a")])]
    (folder / "one.xml").write_text(dumps.document([*pages, dumps.page(7, "B", 0, two), dumps.page(7, "C", 0, [])]), encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("reader", [xml_dump.read_revisions, xml_dump.read_whole_pages])
@pytest.mark.parametrize("split_bytes", [500, 10**8])
def test_pages_of_one_id(spark, twins, tmp_path, reader, split_bytes):
    names = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    for name, value in zip(names, (split_bytes, 1, 200 if split_bytes < 1000 else 1)):
        spark.conf.set(f"spark.sql.files.{name}", str(value))
    try:
        read = reader(spark, twins)
        jobs.extract_identifiers(read, str(tmp_path), pages=xml_dump.read_pages(spark, twins))
        spans = identifiers_history.features(read, "x").collect()
        places = {(r.page_title, r.page_ordinal) for r in read.collect()}
        assert read.drop("is_last", "chrono_pos").transform(lambda x: with_last_flag(x)).where("is_last").count() == 3
        assert quality.dangling_parents(read).count() == 0
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.files.{name}")
    assert len(places) == 3 and len({place for _, place in places}) == 3
    found = sorted((r.page_title, r.identifier_id, str(r.added_ts.day), r.removed_ts and str(r.removed_ts.day)) for r in spans)
    assert found == [
        ("A", "10.1000/a", "1", None), ("A", "10.1000/b", "3", None),
        ("B", "10.1000/c", "2", "4"), ("Between", "10.1000/a", "1", None),
    ]
    root = ET.fromstring(document(tmp_path / "extract-identifiers" / "features"))
    told = {
        page.findtext("title"): [
            [(d.get("action"), i.get("id")) for d in r.iter("diff") for i in d] for r in page.iter("revision")
        ]
        for page in root
    }
    assert told == {
        "A": [[("added", "10.1000/a")], [("added", "10.1000/b")]],
        "B": [[("added", "10.1000/c")], [("removed", "10.1000/c")]],
        "Between": [[("added", "10.1000/a")]],
        "C": [],
    }


def test_last_flags_agree(spark, folder, whole):
    read = xml_dump.read_revisions(spark, folder).select("source_file", "rev_id", "is_last")
    expected = whole.select("source_file", "rev_id", "is_last")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, expected.collect()))


def test_long_page_over_several_part_files(spark, whole, tmp_path, monkeypatch):
    """Part files in name order are the document, also when a page spans them."""
    monkeypatch.setattr(documents, "HISTORY_BLOCK", 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        captured = identifiers.captured(whole)
        fragments = documents.identifiers_document(identifiers.features(captured))
        documents.write_document(fragments, documents.KEYS, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list((tmp_path / "out").glob("*/part-*"))) > 4
    root = ET.fromstring(document(tmp_path / "out"))
    assert [p.find("id").text for p in root.findall("page")] == ["1", "4"]
    ids = [int(r.find("id").text) for r in root.findall("page")[1].iter("revision")]
    assert ids == list(range(400, 460))


def test_report_document(whole, tmp_path):
    report = revision_report.features(whole, "en")
    documents.write_document(documents.report_document(report), documents.KEYS, str(tmp_path / "out"))
    root = ET.fromstring(document(tmp_path / "out"))
    first = next(root.iter("revision"))
    assert [r.text for r in first.find("references_diff/diff").iter("reference")] == ["<ref>b</ref>"]
    assert first.find("publication_identifiers_diff/diff").attrib == {"action": "added"}
    assert first.find("sections/section").text == " References "
    assert first.find("bibliography").text.startswith("== References ==")


def test_texts_are_not_shuffled_at_any_number_of_splits(spark, folder, whole, monkeypatch):
    monkeypatch.setattr(xml_dump, "MAX_BROADCAST_SPLITS", 1)
    names = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    for name, value in zip(names, (400, 1, 200)):
        spark.conf.set(f"spark.sql.files.{name}", str(value))
    try:
        read = xml_dump.read_revisions(spark, folder)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastExchange" in plan
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        assert rows(read) == rows(whole)
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.files.{name}")


def test_compressed_dumps(spark, tmp_path, folder, whole):
    import bz2

    data = Path(folder, "one.xml").read_bytes()
    (tmp_path / "one.xml.gz").write_bytes(gzip.compress(data))
    (tmp_path / "two.xml.bz2").write_bytes(bz2.compress(data))
    read = xml_dump.read_revisions(spark, str(tmp_path))
    same = read.groupBy("source_file").count().collect()
    assert sorted(r["count"] for r in same) == [64, 64]


def test_articles_only(spark, folder, whole):
    expected = rows(articles(whole))
    assert rows(xml_dump.read_whole_pages(spark, folder, articles_only=True)) == expected
    assert rows(xml_dump.read_revisions(spark, folder, articles_only=True)) == expected


def test_pages_and_siteinfo(spark, folder):
    one = Path(folder, "one.xml").as_uri().replace("file:///", "file:///")
    pages = xml_dump.read_pages(spark, folder).where(F.col("source_file").endswith("one.xml"))
    found = pages.orderBy("page_id").select("page_id", "ns", "page_title", "has_revisions").collect()
    assert [tuple(r) for r in found] == [
        (1, 0, "First & only", True), (2, 0, "Empty", False), (3, 1, "Talk:First", True), (4, 0, "Long", True)
    ], one
    site = xml_dump.read_siteinfo(spark, folder).first()
    assert (site.sitename, site.dbname, site.case) == ("Test & co", "testwiki", "first-letter")
    assert [tuple(n) for n in site.namespaces] == [(0, "first-letter", None), (1, "case-sensitive", "Talk")]
    assert quality.siteinfo_violations(xml_dump.read_siteinfo(spark, folder)).count() == 0


def test_find_page(whole):
    assert find_page(whole, "Long").count() == 120
    assert find_page(whole, "long").count() == 0


def test_bibliography_job(spark, folder, whole, tmp_path):
    pages = articles(xml_dump.read_pages(spark, folder))
    site = xml_dump.read_siteinfo(spark, folder)
    jobs.extract_bibliography(whole, str(tmp_path), "en", siteinfo=site, pages=pages)
    root = ET.fromstring(document(tmp_path / "extract-bibliography" / "features"))
    ns = {"m": "http://www.mediawiki.org/xml/export-0.10/"}
    assert [p.find("m:id", ns).text for p in root.findall("m:page", ns)] == ["1", "2", "4"]
    assert root.find("m:siteinfo/m:sitename", ns).text == "Test & co"
    first = root.find("m:page", ns).findall("m:revision", ns)
    assert [r.find("m:text", ns).text for r in first] == [
        "== References ==\n<ref>b</ref> isbn=1", None, None
    ]
    section = first[0].find("m:sections/m:section", ns)
    assert section.attrib == {"name": " References ", "level": "2"}
    assert first[0].find("m:minor", ns) is not None and first[1].find("m:minor", ns) is None
    assert first[1].find("m:contributor/m:ip", ns).text == "10.0.0.1"
    assert first[2].find("m:contributor", ns) is None
    assert len(root.findall("m:page", ns)[2].findall("m:revision", ns)) == 60
    stats = ET.fromstring(document(tmp_path / "extract-bibliography" / "stats"))
    assert stats.find("performance/pages_analyzed").text == "3"
    assert stats.find("performance/revisions_analyzed").text == "63"
    names = stats.find("extracted-section-names/global").findall("section")
    assert [s.attrib for s in names] == [{"name": " References ", "count": "1"}]
    # The document can be read as a dump again.
    again = tmp_path / "again.xml"
    again.write_text(document(tmp_path / "extract-bibliography" / "features"), encoding="utf-8")
    assert xml_dump.read_revisions(spark, str(again)).count() == 63


def test_identifiers_job(spark, folder, whole, tmp_path):
    # Without the optional columns of the page reader.
    revisions = xml_dump.read_revisions(spark, folder)
    jobs.extract_identifiers(revisions, str(tmp_path), compression="gzip")
    root = ET.fromstring(document(tmp_path / "extract-identifiers" / "features"))
    first = root.find("page")
    assert first.find("title").text == "First & only"
    diffs = [
        [(d.attrib["action"], [i.attrib["id"] for i in d.findall("identifier")]) for d in r.iter("diff")]
        for r in first.iter("revision")
    ]
    assert diffs == [[("added", ["10.1000/x", "1"])], [("removed", ["10.1000/x", "1"])], []]
    assert first.find("revisions/revision/user").attrib == {"id": "7", "name": "Ann <1>"}
    stats = ET.fromstring(document(tmp_path / "extract-identifiers" / "stats"))
    found = {a.attrib["where"]: a.attrib["count"] for a in stats.find("identifiers/global")}
    assert found["only_in_filtered_sections"] == "62" and found["only_in_raw_text"] == "0"
    assert len(stats.find("identifiers/last_revision")) == 5


def test_identifiers_job_with_filter_and_only_last(whole, tmp_path):
    result = jobs.extract_identifiers(
        whole, str(tmp_path), filter_sections="bibliography", language="en", only_last=True
    )
    assert result.features.count() == 4
    root = ET.fromstring(document(tmp_path / "extract-identifiers" / "features"))
    assert [len(list(p.iter("revision"))) for p in root.findall("page")] == [1, 1]
    assert not list(root.iter("identifier"))


def test_sections_job(whole, tmp_path):
    jobs.count_sections(whole, str(tmp_path))
    stats = ET.fromstring(document(tmp_path / "count-sections" / "stats"))
    names = stats.find("section-names-per-revision/global").findall("section")
    assert [(s.attrib["name"], s.attrib["count"]) for s in names] == [("references", "1"), ("s", "1")]
    sizes = stats.find("sections-per-revision/global").findall("sections")
    assert [(s.attrib["number"], s.attrib["count"]) for s in sizes] == [("0", "61"), ("1", "2")]
    assert stats.find("revisions/global").attrib["count"] == "63"
    assert stats.find("revisions/last_revision").attrib["count"] == "2"


def test_csv_jobs(spark, folder, whole, tmp_path):
    out = str(tmp_path)
    jobs.extract_page_ids(xml_dump.read_pages(spark, folder), out, "enwiki")
    assert sorted(table(tmp_path / "extract-page-ids" / "features")) == [
        ["enwiki", "1", "First & only"], ["enwiki", "2", "Empty"], ["enwiki", "4", "Long"]
    ]
    jobs.extract_identifiers_history(whole, out, "enwiki")
    spans = table(tmp_path / "extract-identifiers-history" / "features")
    # File order and time order differ: the second revision is the oldest.
    assert spans[0] == [
        "enwiki", "1", "First & only", "doi", "10.1000/x", "2015-01-02T00:00:00Z", "2015-01-03T00:00:00Z"
    ]
    assert [s for s in spans if s[-1] == ""]
    jobs.extract_wikilinks(whole, out, "en")
    links = table(tmp_path / "extract-wikilinks" / "features")
    assert links[0] == [
        "page_id", "page_title", "revision_id", "revision_parent_id", "revision_timestamp", "user_type",
        "user_username", "user_id", "revision_minor", "wikilink.link", "wikilink.anchor",
        "wikilink.section_name", "wikilink.section_level", "wikilink.section_number",
    ]
    assert links[1:] == [
        ["1", "First & only", "12", "11", "2015-01-01T00:00:00Z", "ip", "10.0.0.1", "-1", "0", "a", "b",
         "---~--- incipit ---~---", "0", "0"],
        ["1", "First & only", "12", "11", "2015-01-01T00:00:00Z", "ip", "10.0.0.1", "-1", "0", "c", "c",
         " S ", "1", "1"],
    ]


def test_dry_runs_write_nothing(spark, folder, whole, tmp_path):
    jobs.extract_bibliography(whole, None, "en")
    jobs.extract_identifiers(whole, None)
    jobs.count_sections(whole, None)
    jobs.extract_page_ids(xml_dump.read_pages(spark, folder), None, "x")
    jobs.extract_identifiers_history(whole, None, "x")
    jobs.extract_wikilinks(whole, None, "en", only_last=True)
    assert not list(tmp_path.iterdir())


def test_job_arguments(whole):
    with pytest.raises(ValueError):
        jobs.extract_wikilinks(whole, None, "de")
    with pytest.raises(ValueError):
        jobs.extract_bibliography(whole, None, "xx")
    with pytest.raises(ValueError):
        jobs.count_sections(whole, None, compression="7z")


def test_revision_report(whole):
    report = revision_report.features(whole, "en").where("page_id = 1 AND source_file LIKE '%one.xml'")
    first, second, _ = report.orderBy("rev_pos").collect()
    assert [(c.action, c.item) for c in first.references_diff] == [("added", "<ref>b</ref>")]
    assert [(c.action, c.item) for c in second.references_diff] == [("removed", "<ref>b</ref>")]
    assert [s.name for s in second.sections] == [" S "] and second.bibliography == ""
    assert first.bibliography.startswith("== References ==")


def test_links_of_a_stream(spark, whole, tmp_path):
    folder, out, state = (str(tmp_path / name) for name in ("revisions", "links", "state"))
    batch = whole.select(*COLUMNS)
    batch.where(F.col("source_file").endswith("one.xml")).write.parquet(folder)
    append_wikilinks(revision_stream(spark, folder), "en", out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    batch.where(F.col("source_file").endswith("two.xml")).write.mode("append").parquet(folder)
    append_wikilinks(revision_stream(spark, folder), "en", out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 4
