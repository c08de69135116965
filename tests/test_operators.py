"""Containment, history, counters and integrity checks on small tables."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import counts, history, quality, relate
from palimpsest.operators import revisions as rev

START = datetime(2015, 1, 1)


@pytest.mark.parametrize("size", [6, 60])
def test_contained_by_brute_force(spark, monkeypatch, size):
    rng = random.Random(size)

    def spans(n):
        begins = [rng.randrange(200) for _ in range(n)]
        return [(b, b + rng.randrange(12)) for b in begins]

    rows = [(i, spans(rng.randrange(size)), spans(rng.randrange(size))) for i in range(60)]
    rows.append((60, [(1, 2)], []))
    rows.append((61, [], [(1, 2)]))
    kind = "array<struct<begin:int,end:int>>"
    table = spark.createDataFrame(rows, f"n int, points {kind}, intervals {kind}")
    expected = [
        [any(b >= x and e <= y for x, y in intervals) for b, e in points]
        for _, points, intervals in rows
    ]
    for pairs_per_mark in (0, 50):
        monkeypatch.setattr(relate, "PAIRS_PER_MARK", pairs_per_mark)
        found = table.select("n", relate.contained(F.col("points"), F.col("intervals")).alias("x"))
        assert [r.x for r in found.orderBy("n").collect()] == expected


def test_appearance_classes(apply):
    text = (
        "isbn=1 {{isbn=2}} <ref>isbn=3 {{isbn=4}}</ref>\n== References ==\nisbn=5\n== X ==\nisbn=6"
    )
    keep = relate.section_filter("bibliography", "en")
    (with_filter,) = apply(lambda t: relate.located_identifiers(t, keep), [text])
    assert {c.id: c.appearance for c in with_filter} == {
        "1": relate.IN_RAW_TEXT,
        "2": relate.IN_TEMPLATE,
        "3": relate.IN_REFERENCE,
        "4": relate.IN_BOTH,
        "5": relate.IN_SECTION,
        "6": relate.IN_RAW_TEXT,
    }
    assert [c.id for c in with_filter if c.in_sections] == ["5"]
    (every,) = apply(relate.located_identifiers, [text])
    assert all(c.in_sections for c in every)


def test_section_filter_arguments():
    assert relate.section_filter(None) is None
    with pytest.raises(ValueError):
        relate.section_filter("bibliography")
    with pytest.raises(NotImplementedError):
        relate.section_filter("lists", "en")


def history_rows(seed, pages=12, longest=40):
    """Random pages; times are neither ordered nor unique, one page is much longer."""
    rng = random.Random(seed)
    rows = []
    for page in range(pages):
        n = 400 if page == 0 else rng.randrange(1, longest)
        for pos in range(n):
            ids = [f"doi:{c}" for c in "abc" if rng.random() < 0.5]
            ts = START + timedelta(minutes=20 * rng.randrange(3 * n))
            rows.append((f"f{page % 2}", page, f"P{page}", pos, page * 1000 + pos, ts, ids))
    rng.shuffle(rows)
    return rows


HISTORY = (
    "source_file string, page_id bigint, page_title string, rev_pos int, rev_id bigint,"
    " ts timestamp, ids array<string>"
)


def by_page(rows):
    pages = {}
    for row in rows:
        pages.setdefault((row[0], row[1]), []).append(row)
    return pages


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_changes_in_file_order(spark, block):
    rows = history_rows(2)
    table = spark.createDataFrame(rows, HISTORY)
    got = history.with_changes(table, "ids", "rev_pos", block=block).select(
        "page_id", "rev_id", F.inline("changes")
    )
    expected = Counter()
    for (_, page), revisions in by_page(rows).items():
        before = set()
        for row in sorted(revisions, key=lambda r: r[3]):
            now = set(row[6])
            expected.update((page, row[4], "added", x) for x in now - before)
            expected.update((page, row[4], "removed", x) for x in before - now)
            before = now
    assert Counter(map(tuple, got.collect())) == expected


def test_changes_rebuild_the_items(spark):
    table = spark.createDataFrame(history_rows(4), HISTORY)
    changed = history.with_changes(table, "ids", "rev_pos", block=5)
    pages = {}
    for row in changed.orderBy("page_id", "rev_pos").collect():
        current = pages.setdefault(row.page_id, set())
        for change in row.changes:
            (current.add if change.action == "added" else current.remove)(change.item)
        assert current == set(row.ids)


def test_chronological_position(spark):
    rows = history_rows(3)
    placed = history.with_chronological_position(spark.createDataFrame(rows, HISTORY))
    got = {r.rev_id: r.chrono_pos for r in placed.collect()}
    for revisions in by_page(rows).values():
        for place, row in enumerate(sorted(revisions, key=lambda r: (r[5], r[4]))):
            assert got[row[4]] == place


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_lifespans(spark, block):
    rows = history_rows(6)
    table = spark.createDataFrame(rows, HISTORY)
    spans = history.lifespans(table, "ids", block=block).select(
        "page_id", "item", "added_ts", "removed_ts"
    )
    expected = Counter()
    for (_, page), revisions in by_page(rows).items():
        since = {}
        for row in sorted(revisions, key=lambda r: (r[5], r[4])):
            for item in [x for x in since if x not in row[6]]:
                expected[page, item, since.pop(item), row[5]] += 1
            for item in row[6]:
                since.setdefault(item, row[5])
        expected.update((page, item, ts, None) for item, ts in since.items())
    assert Counter(map(tuple, spans.collect())) == expected


def test_lifespans_of_a_reappearing_identifier(spark):
    t = [START + timedelta(hours=h) for h in range(3)]
    rows = [("f", 1, "P", 0, 1, t[0], ["isbn:x"]), ("f", 1, "P", 1, 2, t[1], []),
            ("f", 1, "P", 2, 3, t[2], ["isbn:x", "isbn:y"])]
    spans = history.lifespans(spark.createDataFrame(rows, HISTORY), "ids")
    assert sorted(tuple(r) for r in spans.select("item", "added_ts").collect()) == [
        ("isbn:x", t[0]), ("isbn:x", t[2]), ("isbn:y", t[2])
    ]
    closed = spans.where("removed_ts IS NOT NULL").select("item", "removed_ts").collect()
    assert [tuple(r) for r in closed] == [("isbn:x", t[1])]


def test_only_last_compares_with_nothing(spark):
    table = spark.createDataFrame([("f", 1, "P", 4, 5, START, ["a:1", "a:0"])], HISTORY)
    (row,) = history.with_changes(table, "ids", only_last=True).collect()
    assert [(c.action, c.item) for c in row.changes] == [("added", "a:0"), ("added", "a:1")]


def test_identifier_key(spark):
    keyed = spark.range(1).select(
        history.identifier_key(F.struct(F.lit("doi").alias("type"), F.lit("10.1/a:b").alias("id"))).alias("k")
    )
    row = keyed.select(history.key_type(F.col("k")), history.key_id(F.col("k"))).first()
    assert tuple(row) == ("doi", "10.1/a:b")


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_last_flag(spark, block):
    table = spark.createDataFrame(history_rows(8), HISTORY)
    flagged = rev.with_last_flag(table, block=block)
    assert flagged.count() == table.count()
    last = flagged.where("is_last").select("page_id", "rev_pos").collect()
    expected = table.groupBy("page_id").agg(F.max("rev_pos")).collect()
    assert sorted(map(tuple, last)) == sorted(map(tuple, expected))


def test_contributor(spark):
    rows = [((1, None),), ((2, (7, "Ann")),), ((3, (None, "10.0.0.1")),)]
    table = spark.createDataFrame([r[0] for r in rows], "n int, user struct<id:bigint,text:string>")
    found = table.orderBy("n").select(*rev.contributor(F.col("user"))).collect()
    assert [tuple(r) for r in found] == [
        ("None", "None", -2), ("registered", "Ann", 7), ("ip", "10.0.0.1", -1)
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_timestamp_in_any_time_zone(spark, zone):
    instants = [0, -1, 1_446_355_800, 1_446_359_400, 1_425_798_000, 253_402_300_799]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = spark.createDataFrame([(i,) for i in instants], "s bigint")
        got = table.select("s", rev.iso_timestamp(F.timestamp_seconds("s")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = datetime(1970, 1, 1)
    assert {r.s: r.t for r in got} == {
        i: (epoch + timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%SZ") for i in instants
    }


def test_counters(spark):
    rows = [("f", "a", True), ("f", "a", False), ("f", "b", False), ("g", "a", True)]
    table = spark.createDataFrame(rows, "source_file string, name string, is_last boolean")
    counted = counts.scoped_counts(table, "source_file", "name")
    assert sorted(map(tuple, counted.collect())) == [
        ("f", "a", "global", 2), ("f", "a", "last_revision", 1), ("f", "b", "global", 1),
        ("g", "a", "global", 1), ("g", "a", "last_revision", 1),
    ]
    ordered = [r["name"] for r in counts.most_common(counted, "name").where("source_file = 'f'").collect()]
    assert ordered == ["a", "b", "a"]


def test_class_counts_report_zeros(spark):
    table = spark.createDataFrame(
        [("f", ["x", "x"], False), ("f", [], True)], "source_file string, c array<string>, is_last boolean"
    )
    assert sorted(map(tuple, counts.class_counts(table, "c", ("x", "y")).collect())) == [
        ("f", "global", "x", 2), ("f", "global", "y", 0),
        ("f", "last_revision", "x", 0), ("f", "last_revision", "y", 0),
    ]


def test_quality(spark):
    rows = [
        ("f", 1, 0, "A", 0, 10, None, START, "wikitext", "text/x-wiki"),
        ("f", 1, 0, "A", 1, 11, 10, START, "wikitext", "text/x-wiki"),
        ("f", 1, 0, "A", 2, 11, 99, START, "7", "text/x-wiki"),
        ("f", 0, -1, None, 0, 12, -5, None, None, "text"),
        ("f", 1, 0, "A", 0, 13, None, START, "wikitext", "text/x-wiki"),
    ]
    table = spark.createDataFrame(
        rows,
        "source_file string, page_id bigint, ns int, page_title string, rev_pos int, rev_id bigint,"
        " parent_id bigint, ts timestamp, model string, format string",
    )
    assert sorted(map(tuple, quality.duplicate_ids(table).collect())) == [
        ("page", "f", 1, 2), ("revision", "f", 11, 2)
    ]
    dangling = quality.dangling_parents(table).select("parent_id", "rev_id").collect()
    assert sorted(map(tuple, dangling)) == [(-5, 12), (99, 11)]
    assert quality.revision_edges(table).count() == 5
    broken = quality.constraint_violations(table).select("rev_id", "rule").collect()
    assert sorted(map(tuple, broken)) == [
        (11, "model_pattern"), (12, "format_pattern"), (12, "model_pattern"), (12, "ns_not_negative"),
        (12, "page_id_positive"), (12, "parent_id_positive"), (12, "timestamp_present"),
        (12, "title_present"),
    ]
    sections = spark.createDataFrame([("a", 1), ("b", 0)], "name string, level int")
    assert [r.name for r in quality.section_level_violations(sections).collect()] == ["b"]


def test_contained_with_more_pairs_than_an_int_counts(spark):
    """50,000 spans among 50,000 intervals."""
    spans = F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda i: F.struct((i * 4).alias("begin"), (i * 4 + 2).alias("end")))
    shifted = F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda i: F.struct((i * 8 - 1).alias("begin"), (i * 8 + 3).alias("end")))
    inside = relate.contained(F.col("points"), F.col("intervals"))
    rows = spark.range(1).select(spans.alias("points"), shifted.alias("intervals")).select(inside.alias("x"))
    (found,) = rows.select(F.size(F.filter("x", lambda x: x)).alias("n"), F.size("x").alias("all")).collect()
    assert (found.n, found["all"]) == (25_000, 50_000)


def test_missing_source_files_and_timestamps_are_kept(spark):
    later = START + timedelta(hours=2)
    rows = [
        (None, 1, "P", 0, 11, None, None, ["doi:a"]),
        (None, 1, "P", 1, 12, 11, START, ["doi:a", "doi:b"]),
        (None, 1, "P", 2, 13, 12, later, ["doi:b"]),
        ("f", 1, "Q", 0, 21, 99, START, []),
    ]
    schema = (
        "source_file string, page_id bigint, page_title string, rev_pos int, rev_id bigint,"
        " parent_id bigint, ts timestamp, ids array<string>"
    )
    table = spark.createDataFrame(rows, schema)
    placed = history.with_chronological_position(table).orderBy("rev_id").collect()
    assert [(r.rev_id, r.chrono_pos) for r in placed] == [(11, 0), (12, 1), (13, 2), (21, 0)]
    flagged = rev.with_last_flag(table).where("is_last").collect()
    assert sorted(r.rev_id for r in flagged) == [13, 21]
    assert [r.rev_id for r in quality.dangling_parents(table).collect()] == [21]
    spans = {(r.item, r.added_ts, r.removed_ts) for r in history.lifespans(table).collect()}
    assert spans == {("doi:a", None, later), ("doi:b", START, None)}


def test_source_files_without_articles_have_zeros(spark):
    rows = spark.createDataFrame([("a", True, ["x"])], "source_file string, is_last boolean, classes array<string>")
    sources = spark.createDataFrame([("a",), ("b",), (None,)], "source_file string")
    every = counts.source_files(sources, rows)
    totals = {r.source_file: (r.pages_analyzed, r.revisions_analyzed) for r in counts.analyzed(rows, None, every).collect()}
    assert totals == {"a": (1, 1), "b": (0, 0), None: (0, 0)}
    found = counts.class_counts(rows, "classes", ("x", "y"), every).where("scope = 'global'").collect()
    assert {(r.source_file, r.key, r["count"]) for r in found} == {
        ("a", "x", 1), ("a", "y", 0), ("b", "x", 0), ("b", "y", 0), (None, "x", 0), (None, "y", 0),
    }
