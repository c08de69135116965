"""Vectors, urls and mixing against plain versions; the pipeline stage by stage."""

import math
import random

import brute
import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
import palimpsest.llm.queries as llm
from palimpsest.llm.components import components
from palimpsest.llm.embedding_dedup import embedding_dedup
from palimpsest.llm.mixing import mix, mixed_documents
from palimpsest.llm.url_filters import Rule, build_cascade, is_listed, url_filter, with_host_and_path
from palimpsest.llm.url_filters import _with_levels as with_levels
from palimpsest.session import ship_package

TABLES = ("documents", "embeddings", "pages", "labels")


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_queries_are_registered():
    names = set(contract.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names and set(llm.ORACLE) <= set(llm.QUERIES)


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = contract.queries()[name](spark, SMALL)
    wanted = database.sql(contract.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert bag(found.collect(), found.columns) == bag(wanted.fetchall(), wanted.columns)


# -- components and vectors ------------------------------------------------------------


def test_components(spark):
    draw = random.Random(6)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)]
    wanted = brute.least_reachable({x for p in links for x in p}, links)
    wanted = {n: c for n, c in wanted.items() if any(n in p and p[0] != p[1] for p in links)}
    table = spark.createDataFrame([*links, (None, 4), (7, None)], "a long, b long")
    assert {r.node: r.component for r in components(table).collect()} == wanted
    assert components(table.limit(0)).collect() == []


def plain_vectors(rows, threshold=0.98):
    def usable(v, label):
        return bool(label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v))

    links = []
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i < j and a == b and usable(v, a) and usable(w, b) and len(v) == len(w):
                cosine = np.dot(v, w) / math.sqrt(np.dot(v, v) * np.dot(w, w))
                if cosine >= threshold:
                    links.append((i, j))
    root = brute.least_reachable(range(len(rows)), links)
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, math.inf), rows[i][0])
    counts = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    return sorted((rows[i][0], int(counts[i]), least[root[i]], rows[i][0] == least[root[i]]) for i in root)


def test_vectors(spark, monkeypatch):
    from palimpsest.llm import embedding_dedup as module

    ship_package(spark)
    monkeypatch.setattr(module, "BLOCK", 16)
    draw = np.random.default_rng(2)
    rows = []
    for label in (1, 2):
        for centre in draw.standard_normal((6, 24)):
            for size in draw.integers(1, 30, 1):
                near = centre + draw.standard_normal((size, 24)) * draw.choice([0.02, 0.1, 0.15])
                rows += [(v.astype(np.float32).tolist(), label) for v in near]
    hub = draw.standard_normal(24)
    rows += [((hub + draw.standard_normal(24) * 0.12).astype(np.float32).tolist(), 3) for _ in range(80)]
    rows += [(rows[0][0], 1)] * 3 + [(rows[0][0], None), (rows[0][0], 2), (None, 1), ([], 1), ([0.0] * 24, 1)]
    rows += [([math.nan] * 24, 1), ([math.inf] + [1.0] * 23, 1), ([None] + [1.0] * 23, 1), ([1.0], 1), ([2.0], 1)]
    order = draw.permutation(len(rows))
    rows = [(int(k) * 3, *row) for k, row in zip(order, rows, strict=True)]
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in ("rep", "n", "links", "h1", "v")})
    assert sorted(map(tuple, embedding_dedup(table).collect())) == plain_vectors(rows)
    nothing = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)], schema)
    assert [tuple(r) for r in embedding_dedup(nothing).collect()] == [(None, 0, None, True)] * 2
    assert embedding_dedup(table.limit(0)).collect() == []


# -- urls ------------------------------------------------------------------------------

ODD_URLS = {
    None: ("", ""),
    "": ("", ""),
    "no-scheme.org/a": ("", ""),
    "http://": ("", ""),
    "HTTP://A.Example.ORG": ("a.example.org", ""),
    "x://É.Org/ES/?q": ("É.org", "/ES/"),
    "x://h#/p": ("h", ""),
    "x://h?/p": ("h", ""),
    "x://h/p?://z/": ("h", "/p"),
    "http://u\nv.com/de/\n#x": ("u\nv.com", "/de/\n"),
}


def test_hosts_and_paths(spark):
    pages = spark.createDataFrame(list(enumerate(ODD_URLS)), "page_id long, url string")
    found = {r.page_id: (r.host, r.path) for r in with_host_and_path(pages).collect()}
    assert list(ODD_URLS.values()) == [found[i] for i in range(len(ODD_URLS))]


@pytest.mark.parametrize("listed", [0, 1, 40, 700, 1000])
def test_cascade_is_exact(spark, listed):
    keys = [(f"h{i}", i < listed) for i in range(1000)]
    levels = build_cascade(spark.createDataFrame(keys, "key string, listed boolean"))
    asked = with_levels(spark.createDataFrame(keys, "key string, listed boolean"), levels)
    assert all(r.listed == r.x for r in asked.select("listed", is_listed(levels, F.col("key")).alias("x")).collect())


def test_url_filter_in_shards(spark):
    urls = [*ODD_URLS, *(f"http://s{i}.com/{i % 3}" for i in range(200)), "http://s1.com/", "http://s1.com/"]
    rows = [(i if i % 7 else None, u, "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    listed = spark.createDataFrame([(f"s{i}.com",) for i in range(0, 200, 9)] + [(None,), ("",), ("absent",)], "key string")
    rules = [Rule("com", "/1", "allow"), Rule("org", "", "block")]
    found = url_filter(pages, listed, rules, filter_bytes=64).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.listed == (r.host in {f"s{i}.com" for i in range(0, 200, 9)})
        rule = "com/1" if r.host.endswith(".com") and r.path.startswith("/1") else None
        rule = "org" if r.host == "org" or r.host.endswith(".org") else rule
        assert r.rule == rule
        verdict = {"com/1": "allow", "org": "block", None: "block" if r.listed else "allow"}[rule]
        assert r.verdict == verdict
    assert url_filter(pages.limit(0), listed, rules).collect() == []


# -- mixing ----------------------------------------------------------------------------


def plain_rates(tokens, p, weights, anchor):
    """Plain steps of small size, until the targets are met."""
    first = tokens @ p
    total = first.sum() if anchor is None else first[anchor] / weights[anchor]
    shift = np.zeros(p.shape[1])
    for _ in range(200_000):
        rate = np.maximum(1 + p @ shift, 0)
        misfit = weights * total - (rate * tokens) @ p
        if np.abs(misfit).max() <= 1e-8 * max(total, 1):
            break
        shift = shift + 0.9 * misfit / first
    return rate


@pytest.mark.parametrize("anchor", [None, "b"])
def test_mixing_reaches_its_targets(spark, anchor):
    draw = random.Random(8)
    sign = {"a": ["alpha", "apple"], "b": ["beta"], "c": ["gamma", "grape"]}
    docs, labelled = [], []
    for i in range(600):
        domain = draw.choices("abc", [6, 3, 1])[0]
        text = " ".join([f"w{draw.randrange(50)}" for _ in range(draw.randrange(5, 60))] + draw.choices(sign[domain], k=2))
        docs.append((i, text, "x"))
        if i % 2:
            labelled.append((i, domain))
    docs += [(600, None, "x"), (601, "", "x"), (None, "alpha beta", "x"), (0, docs[0][1], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, mix_domain string")
    labels = spark.createDataFrame([*labelled, (None, "a"), (3, None), (9999, "a")], "doc_id long, domain string")
    targets = {"a": 0.5, "b": 0.3, "c": 0.2}
    rows = mix(table.drop("mix_domain"), labels, targets, anchor).collect()
    assert len(rows) == len(docs)
    tokens = np.array([r.mix_tokens for r in rows], float)
    p = np.array([r.mix_posterior for r in rows])
    assert np.allclose(p.sum(axis=1), 1) and sorted(tokens) == sorted(len(brute.words(t)) for _, t, _ in docs)
    rate = np.array([r.mix_rate for r in rows])
    weights = np.array(list(targets.values()))
    assert np.allclose(rate, plain_rates(tokens, p, weights, 1 if anchor else None), atol=1e-6)
    reached = (rate * tokens) @ p
    assert np.allclose(reached / reached.sum(), weights, atol=1e-3)
    assert all(math.floor(r.mix_rate) <= r.mix_copies <= math.ceil(r.mix_rate) for r in rows)
    copies = mixed_documents(table, labels, targets, anchor=anchor)
    assert copies.columns == table.columns and copies.count() == sum(r.mix_copies for r in rows)
    assert mix(table.drop("mix_domain").limit(0), labels, targets).collect() == []
    assert {r.mix_rate for r in mix(table.drop("mix_domain").limit(5), labels.limit(0), targets).collect()} is not None


def test_mixing_finds_domains_by_weak_evidence(spark):
    draw, odds = random.Random(12), {"a": [1] * 100, "b": [3] * 10 + [1] * 90, "c": [1] * 90 + [3] * 10}
    domains = ["abc"[i % 10 // 8 + (i % 10 == 9)] for i in range(1500)]
    docs = [(i, " ".join(f"w{k}" for k in draw.choices(range(100), odds[d], k=60))) for i, d in enumerate(domains)]
    labelled = [(i, d) for i, d in enumerate(domains) if i < 1000]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, domain string")
    found = {r.doc_id: r.mix_posterior for r in mix(table, labels, {"a": 0.6, "b": 0.2, "c": 0.2}).collect()}
    for k, d in enumerate("abc"):
        assert sum(found[i][k] for i, _ in labelled) / 1000 == pytest.approx([0.8, 0.1, 0.1][k], abs=0.02)
        held_out = [found[i][k] for i in range(1000, 1500) if domains[i] == d]
        others = [found[i][k] for i in range(1000, 1500) if domains[i] != d]
        assert sum(held_out) / len(held_out) > sum(others) / len(others) + 0.3
        assert sum(x > 0.5 for x in held_out) > (0.3 if k else 0.9) * len(held_out)


def test_mixing_reaches_a_target_of_many_times_the_tokens(spark):
    rows = [(i, ("rare " if i % 50 == 0 else "plain ") * 40) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "a" if i % 50 else "b") for i in range(1000)], "doc_id long, domain string")
    found = mix(docs, labels, {"a": 0.7, "b": 0.3}, "a").collect()
    reached = [sum(r.mix_rate * r.mix_tokens * r.mix_posterior[k] for r in found) for k in (0, 1)]
    assert reached[1] / sum(reached) == pytest.approx(0.3, abs=1e-5)
    assert max(r.mix_rate for r in found) > 15
    # Documents that are all alike cannot be mixed: the misfit is told.
    alike = docs.withColumn("text", F.lit("same words"))
    with pytest.warns(UserWarning, match="not reached"):
        told = mix(alike, labels, {"a": 0.5, "b": 0.5}).first().mix_misfit
    assert max(map(abs, told)) > 100


# -- the pipeline ----------------------------------------------------------------------


def test_pipeline_by_stages(spark):
    """What each stage keeps, from the rows that the one before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "passage_dedup", "mixing", "packing",
    ]
    columns = docs.columns
    good = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.quality == 1}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()] if name != "packing" else None
        found = stage(spark, docs, SMALL).cache()
        if name == "packing":
            packed = {r.doc_id for r in found.collect()}
            assert packed == {r.doc_id for r in docs.collect()}
            break
        assert found.columns == columns
        after = sorted((r.doc_id, r.text) for r in found.collect())
        if name == "quality":
            weights = brute.ratios(before, good)
            assert after == sorted(
                (i, t) for i, t in before if not brute.base_counts(t)[-1] and brute.score(t, weights) >= -0.5
            )
        elif name == "near_dedup":
            assert after == sorted((i, t) for i, t in before if brute.near_classes(before)[i] == i)
        elif name == "passage_dedup":
            kept = zip(before, brute.repeated(before, 50), strict=True)
            wanted = sorted((i, [w for w, g in zip(brute.words(t), gone, strict=True) if not g]) for (i, t), gone in kept)
            assert [(i, brute.words(t)) for i, t in after] == wanted
            assert all(r.n_chars == len(r.text) for r in found.collect())
        docs = found


def test_pipeline_runs(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert "sequence_id" in found.columns and found.count() > 0


def tables(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_of_missing_and_repeated_ids(spark, tmp_path):
    """Rows without id or text and unlike texts of one id go through; a copy goes, an unlike text does not."""
    draw = random.Random(41)
    texts = [" ".join(f"w{draw.randrange(900)}" for _ in range(120)) for _ in range(12)]
    ids = [1, 2, 3, 4, 5, 5, 6, 7, 8, 9, None, None]
    docs = [(i, t, "en", "a", len(t)) for i, t in zip(ids, texts, strict=True)]
    docs += [(5, texts[4], "en", "b", len(texts[4])), (20, None, None, None, None), (None, None, "en", "a", 0), (21, "", "en", "a", 0)]
    folder = tables(spark, tmp_path, docs, [(i, 1, int(i == 9)) for i in range(1, 10)] + [(None, 1, 0), (5, None, None)])
    quality = corpus_pipeline.quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    kept = corpus_pipeline.near_dedup(spark, quality, folder)
    wanted = {(i, t) for i, t, *_ in quality.collect()}
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(found) == len(set(found)) == len({t for _, t in wanted})
    assert {(5, texts[4]), (5, texts[5])} <= set(found)
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} <= {i for i, _ in wanted}


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [])).collect() == []
