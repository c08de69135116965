"""Fuzzy section names against a plain scorer."""

import random
import re

import pytest

from palimpsest.functions import languages
from palimpsest.functions.matching import is_bibliography, matches_terms


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def ratio(a, b):
    return int(round(200 * common(a, b) / (len(a) + len(b)))) if a and b else 0


def partial(a, b):
    """The best window of the longer string that is as long as the shorter one."""
    a, b = sorted((a, b), key=len)
    return max(ratio(a, b[i : i + len(a)]) for i in range(len(b) - len(a) + 1)) if a else 0


def score(name, term):
    def clean(s):
        return re.sub(r"\W", " ", re.sub("[\x80-\xff]", "", s)).lower().strip()

    a, b = clean(name), clean(term)
    if not a or not b:
        return 0
    base = ratio(a, b)
    far = max(len(a), len(b)) / min(len(a), len(b))
    if far >= 1.5:
        weight = 0.6 if far > 8 else 0.9
        in_order = partial(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
        x, y = set(a.split()), set(b.split())
        sets = 100 if x & y else partial(" ".join(sorted(x)), " ".join(sorted(y)))
        return int(max(base, partial(a, b) * weight, in_order * 0.95 * weight, sets * 0.95 * weight))
    in_order = ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    x, y = set(a.split()), set(b.split())
    shared = " ".join(sorted(x & y))
    one = (shared + " " + " ".join(sorted(x - y))).strip()
    two = (shared + " " + " ".join(sorted(y - x))).strip()
    sets = max(ratio(shared, one), ratio(shared, two), ratio(one, two))
    return int(max(base, 0.95 * in_order, 0.95 * sets))


def test_known_names(apply):
    yes = ["References", " references ", "Refernces", "Source", "See references",
           "Reading further", "Publications list", "BIBLIOGRAPHY", "Notes:", "foot-notes"]
    no = ["Note", "Notes and references", "References and notes", "See also", "History",
          "External links", "Bibliografia", "", "  ", "Further", "..."]
    assert apply(lambda t: is_bibliography(t, "en"), yes + no) == [True] * len(yes) + [False] * len(no)
    assert apply(lambda t: is_bibliography(t, "it"), ["Bibliografia", "References"]) == [True, False]


def mutated(rng, term):
    chars = list(term)
    for _ in range(rng.randrange(5)):
        at, kind = rng.randrange(len(chars) + 1), rng.random()
        if kind < 0.4:
            chars.insert(at, rng.choice("abcdefghinorst  éE_-"))
        elif chars and kind < 0.8:
            chars.pop(min(at, len(chars) - 1))
        elif chars:
            chars[min(at, len(chars) - 1)] = rng.choice("abcdefghinorst ")
    words = "".join(chars).split(" ")
    if rng.random() < 0.3:
        rng.shuffle(words)
    if rng.random() < 0.15:
        words.append(rng.choice(words))
    return rng.choice(["", "", "", "a ", "the ", "see "]) + " ".join(words)


@pytest.mark.parametrize(
    "terms, cutoff",
    [(languages.BIBLIOGRAPHY["en"], 91), (("works cited here", "list of sources", "a b c d"), 93)],
)
def test_against_plain_scorer(apply, terms, cutoff):
    rng = random.Random(1)
    names = [mutated(rng, rng.choice(terms)) for _ in range(2500)]
    got = apply(lambda t: matches_terms(t, terms, cutoff), names)
    expected = [any(score(n, t) >= cutoff for t in terms) for n in names]
    assert 200 < sum(expected) < 2400
    assert [n for n, g, e in zip(names, got, expected) if g != e] == []


LONG = "a list of works that were cited in the text above with all of their editions and translations into other languages as far as they are known to the editors"
TERMS = {
    "usual": languages.BIBLIOGRAPHY["en"],
    "long": (LONG, "works cited here", "list of sources", " ".join(["note"] * 20)),
    "letters": ("Библиография", "Примечания и ссылки", "参考文献", "Références", "Kaynakça ve notlar", "𝒳 notes"),
}


@pytest.mark.parametrize("cutoff", [1, 38, 63, 70, 86, 91])
@pytest.mark.parametrize("dictionary", TERMS)
def test_any_cutoff_and_term(apply, dictionary, cutoff):
    rng, terms = random.Random(cutoff), TERMS[dictionary]
    names = [mutated(rng, rng.choice(terms)) for _ in range(40)]
    names += [name[: rng.randrange(len(name) + 1)] for name in names[:30]]
    names += [" ".join(rng.sample(names, 2)) for _ in range(20)] + ["x", "s", "", "  ", "no no no", "é", LONG[40:90]]
    names += ["".join(rng.choice("notesrfc ") for _ in range(rng.randrange(1, 40))) for _ in range(20)]
    got = apply(lambda t: matches_terms(t, terms, cutoff), names)
    expected = [max(score(n, t) for t in terms) >= cutoff for n in names]
    assert [(n, g) for n, g, e in zip(names, got, expected) if g != e] == []


def test_low_and_high_plans_agree(apply):
    """The plan for any cutoff gives what the plan for high ones does."""
    from palimpsest.functions import matching

    rng, terms = random.Random(3), languages.BIBLIOGRAPHY["en"]
    names = [mutated(rng, rng.choice(terms)) for _ in range(300)]
    one = apply(lambda t: matches_terms(t, terms, 91), names)
    two = apply(lambda t: matching.let(matching.normalised(t), lambda x: matching._any_score(x, terms, 91)), names)
    assert one == two


def test_every_name_reaches_nothing(apply):
    names = ["notes", "", "anything", None]
    assert apply(lambda t: matches_terms(t, ("notes",), 0), names) == [True, True, True, False]
    assert apply(lambda t: matches_terms(t, ("é", "..."), 50), names) == [False, False, False, None]


def test_arguments():
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        languages.check_language("de")
    with pytest.raises(ValueError):
        languages.citation_terms("it")
    with pytest.raises(ValueError):
        matches_terms(F.lit("a"), ("notes",), score_cutoff=101)


def test_cheap_bounds_come_first_and_hold(spark):
    from pyspark.sql import functions as F

    from palimpsest.functions import matching

    scores = matching._Scores(1)
    for test in (scores.whole("w.text", "t.plain", 70), scores.partial("w.text", "t.plain", 78)):
        assert 0 < test.index("levenshtein(") < test.index("aggregate(")
    rng = random.Random(5)
    names = [mutated(rng, rng.choice(TERMS["usual"] + TERMS["letters"])) for _ in range(300)]
    pairs = list(zip(names, reversed(names)))
    rows = spark.createDataFrame(pairs, "a string, b string")
    for row in rows.withColumn("most", F.expr(matching._most_common("a", "b"))).collect():
        assert row.most >= common(row.a, row.b)
