"""Importance resampling, Katz scores and collocations against plain versions."""

import random

import brute
import numpy as np
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

import palimpsest.llm.collocations as phrases
import palimpsest.llm.katz as katz
import palimpsest.llm.mixing as mixing
import palimpsest.llm.queries as llm
from palimpsest.llm.planes import packed, packed_floats, unpacked, unpacked_floats
from palimpsest.llm.resampling import Grams, Interned, gains, resample
from palimpsest.session import ship_package

CLASHING = ("bucket", "n", "place", "score", "a", "phrase", "block", "rank", "a.b")


def clashing(table):
    return table.withColumns({c: F.lit(1) for c in CLASHING})


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def drawn_texts(seed, n=60):
    """Texts of few words, so that n-grams repeat, among awkward ones."""
    draw = random.Random(seed)
    usual = ["The", "the", "cat", "Éa", "x1", "don't", "long" * 20, "long" * 20 + "er", "日本", "a\x00b", "A_b", "ﬀ"]
    marks = [" ", "  ", "\t", "\n", ". ", ", ", "; x", " - ", "\x0b", " ", "!?", "\r\n"]
    texts = ["".join(draw.choice(usual) + draw.choice(marks) for _ in range(draw.randrange(1, 60))) for _ in range(n)]
    return [*texts, None, "", "  ", "...", texts[0], texts[0]]


# -- resampling ------------------------------------------------------------------------


def test_hashes_are_those_of_the_library():
    draw = np.random.default_rng(1)
    raw = [draw.integers(0, 256, k).astype(np.uint8).tobytes() for k in [*range(80)] * 2]
    end = np.cumsum([len(x) for x in raw])
    grams = Grams(np.frombuffer(b"".join(raw), np.uint8), end - [len(x) for x in raw], end)
    assert [int(k) for k in grams.keys] == [xxhash.xxh64_intdigest(x) for x in raw]


@pytest.mark.parametrize("lost", [0, 60, 64])
def test_equal_hashes_are_told_apart_by_their_bytes(lost):
    raw = [w.encode() for w in ("a", "b", "a", "c" * 40, "c" * 39 + "d", "c" * 40, "b", "a", "ab")] * 30
    end = np.cumsum([len(x) for x in raw])
    grams = Grams(np.frombuffer(b"".join(raw), np.uint8), end - [len(x) for x in raw], end)
    grams.keys = grams.keys >> np.uint64(min(lost, 63)) if lost < 64 else np.zeros_like(grams.keys)
    found = Interned(grams, 1000)
    slot = dict(zip(raw, found.slots.tolist(), strict=True))
    assert [slot[x] for x in raw] == found.slots.tolist() and len(set(slot.values())) == len(slot)
    assert {x: found.count[s] for x, s in slot.items()} == {x: raw.count(x) for x in slot}


@pytest.mark.parametrize("size", [1, 3])
def test_resampling(spark, monkeypatch, size):
    texts = drawn_texts(3)
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    target = [*drawn_texts(4, 5), "cat cat"]
    options = {"buckets": 50, "least_words": 5, "percent": 30}
    table = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    key = repr
    found = resample(table, bench, size, **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute.resampled(docs, target, size, **options), key=key)
    assert resample(table.limit(0), bench, size).collect() == []
    none = brute.resampled(docs, [], size, **options)
    assert sorted(map(tuple, resample(table, bench.limit(0), size, **options).collect()), key=key) == sorted(none, key=key)


def test_occurrences_are_interned_in_pieces(spark, monkeypatch):
    from palimpsest.llm import resampling

    texts = drawn_texts(5)
    words = [len(brute.features(t, 2)[0]) for t in texts]
    for limit in (1, 7, 1000):
        monkeypatch.setattr(resampling, "OCCURRENCES", limit)
        import pyarrow as pa

        n = np.zeros(len(texts), int)
        for text, found in resampling.features(pa.array(texts, pa.string()), 2, 100):
            np.add.at(n, text, 1)
            assert found.count.sum() == len(text)
        assert n.tolist() == words


def test_gains_are_bounded_by_buckets(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert len(gains(docs, docs.limit(0), 2, 7)) == 7


# -- Katz ------------------------------------------------------------------------------


def test_packed_numbers():
    draw = np.random.default_rng(2)
    for high in (1, 255, 256, 70_000, 1 << 40):
        values = draw.integers(0, high, 1000)
        assert unpacked(packed(values)).tolist() == values.tolist()
    assert unpacked(packed(np.zeros(0, np.int64))).tolist() == []
    floats = np.round(draw.random(500), 1)
    assert unpacked_floats(packed_floats(floats)).tolist() == floats.tolist()


def test_katz_probabilities_sum_to_one():
    rows = [(i, t, i % 4 > 0) for i, t in enumerate(drawn_texts(6))]
    model = brute.Katz(rows, 3)
    words = [w for (w,) in model.grams[1]] + ["never seen"]
    for n in (1, 2, 3):
        for context in model.followers[n]:
            assert sum(model.p(n, context, w) for w in words) == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("order, split, block", [(1, 1 << 20, 4 << 20), (2, 5, 300), (3, 3, 1000)])
def test_katz_scores(spark, monkeypatch, order, split, block):
    monkeypatch.setattr(katz, "SPLIT", split)
    monkeypatch.setattr(katz, "BLOCK_WORDS", block)
    docs = [(i if i % 9 else None, t) for i, t in enumerate(drawn_texts(7, 150))]
    table = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    found = katz.katz_scores(table, F.col("doc_id") % 5 != 1, order).collect()
    wanted = list(brute.Katz([(i, t, i is None or i % 5 != 1) for i, t in docs], order).rows())
    key = lambda r: (repr(r[:5]), round(r[6], 6))
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in wanted], rtol=1e-9)


def test_katz_table(spark):
    docs = [(i, t) for i, t in enumerate(drawn_texts(8))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    model = brute.Katz([(i, t, True) for i, t in docs], 2)
    found = katz.katz_table(table, F.lit(True), 2).collect()
    wanted = [(c, model.p(2, g[:1], g[1]), model.weighed(2, g[:1])[2]) for g, c in model.grams[2].items()]
    assert len({(r.context, r.word) for r in found}) == len(found) == len(wanted)
    found = sorted((r["count"], r.probability, r.backoff) for r in found)
    assert np.allclose(found, sorted(wanted), rtol=1e-9)


def test_katz_without_rows_to_learn_from(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = katz.katz_scores(table, F.lit(False), 2).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found) == [
        (1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0),
    ]
    assert katz.katz_scores(table.limit(0), F.lit(True), 2).collect() == []


def test_katz_is_better_than_its_base_on_held_out_texts(spark):
    rows = llm.QUERIES["op11_katz_scoring"](spark, SMALL).collect()
    held_out = [r for r in rows if r.held_out]
    assert held_out and len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


# -- collocations ----------------------------------------------------------------------


@pytest.mark.parametrize("longest, least, first, sampled", [(3, 2, 2000, 1), (2, 3, 5, 50), (4, 2, 40, 3)])
def test_collocations(spark, monkeypatch, longest, least, first, sampled):
    monkeypatch.setattr(phrases, "SAMPLE_LEAST", sampled)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 200)
    docs = [([None, "en", "und", "x y"][i % 4], t) for i, t in enumerate(drawn_texts(9, 120))]
    table = clashing(spark.createDataFrame(docs, "lang string, text string"))
    found = phrases.collocations(table, longest, least, first=first).collect()
    assert sorted(map(tuple, found)) == brute.collocations(docs, longest, least, first=first)
    assert phrases.collocations(table.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    """The score's expression on counts whose products have more than 64 bits."""
    rows = [(10**13, 3 * 10**13, 10**13), (123456789012345, 123456789012346, 123456789012347)]
    table = spark.createDataFrame(rows, "a long, l long, r long")
    found = [r.score for r in table.select(phrases.cut_score().alias("score")).collect()]
    assert found == [10**6 * a * a // (l * r) for a, l, r in rows]


def test_the_mixing_model_is_not_copied_into_the_labelled_rows(spark):
    rows = spark.createDataFrame(
        [("good", 2, [0, 1]), ("toxic", 3, [1])], "mix_domain string, mix_tokens long, mix_found array<int>"
    )
    table = [[[0.1, 0.0, -0.2, 0.0], [0.3, 0.3, -0.4, 0.0]], [[0.5, 0.0, -0.6, 0.0], [0.7, 0.0, -0.8, 0.0]]]
    model = spark.createDataFrame([tuple(table)], "all array<array<double>>, others array<array<double>>")
    told = mixing._told(rows, model, ["good", "toxic"])
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "AS mix_all#" not in plan and "AS mix_others#" not in plan and "AS mix_model#" not in plan
    found = {r.mix_domain: r for r in told.collect()}
    assert found["good"].e0_1 == pytest.approx((0.5 + 0.7) / 2)
    assert found["good"].e1_1 == pytest.approx((-0.2 - 0.4) / 2)
    assert found["toxic"].e0_0 == pytest.approx(0.3)
    assert found["toxic"].e1_1 == pytest.approx(-0.8)
