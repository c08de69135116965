"""Operators on documents against plain versions, on a given table and on awkward rows."""

import math
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import palimpsest.llm.queries as llm
from palimpsest.llm.minhash import bags, near_duplicates, one_of_each, shingles, signatures
from palimpsest.llm.packing import Encoder, pack
from palimpsest.llm.quality_classifier import fit
from palimpsest.llm.quality_rules import keep_good, quality_rules, weights
from palimpsest.llm.repeats import HASHES_ARROW, DifferenceCover, _shared
from palimpsest.llm.substring_dedup import substring_dedup, with_digest
from palimpsest.llm.suffix_array import Suffixes
from palimpsest.llm.suffix_dedup import cut_passages, suffix_dedup
from palimpsest.llm.token_counts import Shortcut, token_counts
from palimpsest.llm.words import words_of
from palimpsest.session import ship_package

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
STOCK = [f"w{i}" for i in range(400)]


def prose(seed, n):
    return " ".join(random.Random(seed).choices(STOCK, k=n))


LONG = prose(1, 30_000)
# Nulls, empty and very long texts, ties, repeats, and columns named as operators name theirs.
AWKWARD = [
    (1, LONG, 1),
    (2, None, None),
    (3, "", 3),
    (4, " \n\t \x0b\f\r ", 4),
    (5, prose(2, 120), 5),
    (5, prose(2, 120), 5),
    (6, prose(2, 120), 6),
    (7, prose(3, 60) + " " + prose(2, 100), 7),
    (None, prose(2, 120), 8),
    (None, None, 9),
    (8, "one two three", 10),
    (9, "one two three", 11),
    (10, prose(4, 200), 12),
    (11, prose(4, 200) + " tail", 13),
    (12, "x\xa0y　z é\x1c\x85 ▁ <s> <|endoftext|>  two  spaces\n\nlines \n", 14),
]
SCHEMA = (
    "doc_id long, text string, kept int, row int, n_words int, block int, bucket int, score int,"
    " mix_rate int, gone int, id int, place int, rows int, source string, n_chars long"
)


@pytest.fixture(scope="module")
def awkward(spark):
    ship_package(spark)
    rows = [(i, t, x, x, x, x, x, x, x, x, x, x, x, None, len(t or "")) for i, t, x in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def as_set(found):
    return sorted(map(repr, map(tuple, found.collect())))


def both(rows):
    return [(i, t) for i, t, *_ in rows]


# -- token counts and packing ----------------------------------------------------------


def test_token_counts(spark, awkward, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def plain(some):
        out = []
        for i, text in some:
            n = len(model.encode(text or ""))
            out.append(repr((i, len((text or "").encode()), n, n > 4096)))
        return sorted(out)

    assert as_set(llm.QUERIES["op1_token_counts"](spark, SMALL)) == plain(rows)
    assert as_set(token_counts(awkward, PIECES, 4096)) == plain(both(AWKWARD))
    assert token_counts(awkward.limit(0), PIECES, 4096).collect() == []


def test_shortcut_on_random_texts():
    counter, draw = Shortcut(PIECES), random.Random(3)
    assert counter.separable and len(counter.whole) > 30_000
    signs = [" ", "  ", "\n", "▁", "a", "the", "é", ".", "\t", "\x00", "<s>", "漢", "Ǆ", " re"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(30))) for _ in range(1500)]
    assert counter.counts(texts) == [len(x) for x in counter.model.encode(texts)]


def test_encoder_on_random_texts():
    encoder, draw = Encoder(BYTES), random.Random(4)
    assert encoder.chunked
    signs = [" ", "  ", "\n", "\t", "a", "'s", "'", "é", "　", "\xa0", "\x85", "\x1c", " ",
             "<|endoftext|>", "1", "٣", "the", "。", "😀", "​", "_"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(30))) for _ in range(1500)]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]


@pytest.mark.parametrize("window", [1024, 8])
def test_packing_is_a_round_trip(awkward, rows, documents, window):
    tokenizer = Tokenizer.from_file(BYTES)
    for table, texts in ((documents, rows), (awkward, both(AWKWARD))):
        pieces = pack(table, BYTES, window).collect()
        assert all(zlib.crc32(p.ids) >= 0 and len(p.ids) == 4 * p.length > 0 for p in pieces)
        found = {}
        for p in pieces:
            found.setdefault(p.doc_id, []).append(p)
        wanted = {}
        for i, text in texts:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            wanted.setdefault(i, []).append(ids)
        assert found.keys() == wanted.keys()
        for i, copies in wanted.items():
            parts = sorted(found[i], key=lambda p: (p.sequence_id, p.offset))
            ids = np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist()
            assert sorted(ids) == sorted(sum(copies, []))
            if len(copies) == 1:
                assert ids == copies[0]
                assert [p.start for p in parts] == np.cumsum([0, *(p.length for p in parts[:-1])]).tolist()
                assert {p.doc_tokens for p in parts} == {len(ids)}
        at = 0
        for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
            assert p.sequence_id * window + p.offset == at and p.offset + p.length <= window
            at += p.length
        for p in pieces:
            filled = min(window, at - p.sequence_id * window)
            assert p.padded == (filled if filled & (filled - 1) == 0 else window)
    assert pack(awkward.limit(0), BYTES, window).collect() == []


# -- quality ---------------------------------------------------------------------------


def test_quality_rules(spark, rows, labels):
    weights = brute.ratios(rows, {r.doc_id for r in labels.collect() if r.quality == 1})
    found = {r.doc_id: r for r in llm.QUERIES["op2_quality_rules"](spark, SMALL).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        r = found[i]
        wanted = brute.base_counts(text)
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == wanted
        assert r.score == pytest.approx(brute.score(text, weights), abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= -0.5)


def test_quality_rules_on_awkward_rows(awkward, labels):
    found = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_repeat_words, r.base_failed) for r in quality_rules(awkward, labels).collect())
    wanted = []
    for i, text in both(AWKWARD):
        n, chars, _, _, repeat, failed = brute.base_counts(text)
        wanted.append((repr(i), n, chars, repeat, failed))
    assert found == sorted(wanted)
    kept = keep_good(awkward, labels.limit(0))
    assert kept.columns == awkward.columns
    good = [i for i, _, _, _, failed in wanted if not failed]
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(good)
    assert quality_rules(awkward.limit(0), labels).collect() == []


def test_every_trusted_document_counts(spark):
    # More trusted rows than were once counted at most; each has a unit of its own bucket or so.
    n = 200_500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("good").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(n, "bad"), (None, "good")], "doc_id long, text string"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    found = weights(docs, labels, 64, 1.0).first().w
    bucket = brute.spark_hash("good") % 64
    assert found[bucket] == pytest.approx(math.log((n + 1) / (n + 64)) - math.log((n + 2) / (n + 2 + 64)), abs=1e-12)


def test_quality_classifier(spark, rows, labels):
    found = llm.QUERIES["op9_quality_classifier"](spark, SMALL).collect()
    assert len(found) == len(rows)
    good = {r.doc_id: r.quality for r in labels.collect()}
    right = wrong = 0
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in good:
            right, wrong = right + (r.predicted == good[r.doc_id]), wrong + (r.predicted != good[r.doc_id])
    assert right > 9 * wrong


def test_quality_classifier_on_awkward_rows(spark, awkward):
    from palimpsest.llm.quality_classifier import quality_scores

    labels = spark.createDataFrame([(1, 1, 9), (5, 0, 9), (None, 1, 9), (7, None, 9)], "doc_id long, quality int, text int")
    assert len(quality_scores(awkward, labels).collect()) == len(AWKWARD)
    (score,) = {r.score for r in quality_scores(awkward, labels.limit(0)).collect()}
    assert score == 0.5
    assert quality_scores(awkward.limit(0), labels).collect() == []


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


# -- repeats ---------------------------------------------------------------------------


@pytest.mark.parametrize("size", [13, 50])
def test_repeats(spark, awkward, rows, size):
    name, operator = {13: ("op6_substring_dedup", substring_dedup), 50: ("op8_suffix_dedup", suffix_dedup)}[size]
    wanted = sorted(map(repr, brute.substring_rows(rows, size)))
    assert as_set(llm.QUERIES[name](spark, SMALL)) == wanted
    wanted = sorted(map(repr, brute.substring_rows(both(AWKWARD), size)))
    assert as_set(with_digest(operator(awkward, size))) == wanted
    assert operator(awkward.limit(0), size).collect() == []


@pytest.mark.parametrize("operator, size", [(substring_dedup, 13), (suffix_dedup, 50)])
@pytest.mark.parametrize("ids", [(5, 7, 5), (7, 5, 7), (5, 7, 5, None)])
def test_repeats_of_ids_that_alternate(spark, operator, size, ids):
    ship_package(spark)
    rows = [(i, f"t{k} {prose(8, 70)} u{k}") for k, i in enumerate(ids)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    wanted = sorted(map(repr, brute.substring_rows(rows, size)))
    assert as_set(with_digest(operator(table, size))) == wanted


def test_cut_passages_keeps_columns_and_white_space(spark, awkward):
    found = cut_passages(awkward, 50)
    assert found.columns == awkward.columns and found.count() == len(AWKWARD)
    text = "\n".join(prose(7, 60).split())
    table = spark.createDataFrame(
        [(1, f"a\tb  {text} c", 0), (2, f"x\ty  {text}\n z", 0)], "doc_id long, text string, n_chars long"
    )
    assert [tuple(r) for r in cut_passages(table, 50).orderBy("doc_id").collect()] == [
        (1, f"a\tb  {text} c", 0), (2, "x\ty  z", 6),
    ]


def test_matches_reach_any_number_of_words_to_both_sides(spark):
    """Few different words, so that most suffixes have several neighbours that differ left or right."""
    ship_package(spark)
    draw = random.Random(21)
    rows = [(i, " ".join(draw.choice("aab") + draw.choice("xy") for _ in range(draw.randrange(60)))) for i in range(80)]
    rows += [(100 + i, "ax " * 70 + f"end{i}") for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    wanted = sorted(map(repr, brute.substring_rows(rows, 8)))
    found = with_digest(suffix_dedup(table, 8))
    assert as_set(found) == wanted
    removed = [r.n_removed for r in found.collect()]
    assert 0 in removed and any(removed)


def test_retained_suffixes_and_their_matches():
    """Every window retains a suffix, few are retained, and a match is found from its shared suffix alone."""
    passage = prose(31, 60)
    texts = [f"{prose(32, 3000)} {passage} {prose(33, 500)}", f"{prose(34, 400)} {passage} {prose(35, 900)}"]
    kind = Suffixes(50, 12)
    words = words_of(pa.array(texts))
    _, at = kind.anchors(words)
    windows = words.windows(50)
    assert (np.searchsorted(at, windows + 50 - 12, side="right") > np.searchsorted(at, windows)).all()
    assert 0.03 < len(at) / len(words.hashes) < 0.08
    starts = [len(texts[0].split()) - 560, len(texts[1].split()) - 960 + words.first[1]]
    inside = [set((at[(at >= s) & (at <= s + 48)] - s).tolist()) for s in starts]
    assert inside[0] & inside[1]
    # Blocks of one document each: what the bucket tells of the second one's suffixes.
    blocks = [kind.open(1, i, pa.table({"doc_id": pa.array([i], pa.int64()), "text": [texts[i]]})) for i in (0, 1)]
    told = [pa.Table.from_pylist(list(b.anchor_rows()), HASHES_ARROW) for b in blocks]
    shared = _shared(pa.concat_tables(told))
    replies = [shared.filter(pa.array(b == i for b in shared["block"].to_pylist())) for i in (0, 1)]
    sent = []
    for block, reply in zip(blocks, replies, strict=True):
        block.look_around(reply)
        sent.append(pa.Table.from_pylist(list(block.window_rows()), HASHES_ARROW))
    assert 0 < len(blocks[1].heads) < 10
    earlier = kind.answer(pa.concat_tables(sent))
    assert not blocks[0].repeated(earlier.slice(0, 1)).any()
    gone = np.flatnonzero(blocks[1].repeated(earlier.slice(1, 1)))
    assert gone.tolist() == list(range(len(texts[1].split()) - 960, len(texts[1].split()) - 900))


def test_difference_cover_is_checked():
    with pytest.raises(ValueError):
        DifferenceCover(13, 7, (0, 1, 2))


# -- near duplicates -------------------------------------------------------------------


def test_near_duplicates(spark, rows):
    wanted = brute.near_classes(rows)
    found = {r.doc_id: (r.class_id, r.kept) for r in llm.QUERIES["op5_minhash_dedup"](spark, SMALL).collect()}
    assert found == {i: (c, c == i) for i, c in wanted.items()}
    assert any(c != i for i, c in wanted.items())


def test_near_duplicates_on_awkward_rows(awkward):
    found = sorted((repr(r.doc_id), repr(r.class_id), r.kept) for r in near_duplicates(awkward).collect())
    classes = {6: 5, 9: 8, 11: 10}
    assert found == sorted((repr(i), repr(classes.get(i, i)), i not in classes) for i, _ in both(AWKWARD))
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [1, 2, 3, 4, 5, 7, None, None, 8, 10, 12]
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(map(repr, ids))
    assert near_duplicates(awkward.limit(0)).collect() == []


def test_blocks_of_a_large_group_lose_no_link(spark, monkeypatch):
    from palimpsest.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 4)
    draw = random.Random(9)
    base = prose(11, 150).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(draw.randrange(8)):
            w[draw.randrange(150)] = f"new{draw.randrange(1000)}"
        rows.append((i, " ".join(w)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in found.collect()} == brute.near_classes(rows)


def test_signatures_estimate_weighted_jaccard():
    draw = random.Random(5)
    texts = []
    for _ in range(2):
        texts.append(" ".join(w for w in STOCK[:60] for _ in range(draw.choice([0, 1, 1, 2, 3, 9, 20]))))
    words = words_of(pa.array(texts))
    points = signatures(*bags(*shingles(words, 1)), 2, 4096)
    assert (points != 0).all()
    assert (points[0] == points[1]).mean() == pytest.approx(brute.jaccard(brute.bag(texts[0], 1), brute.bag(texts[1], 1)), abs=0.03)
