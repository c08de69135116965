"""Publication identifiers on known and on random texts."""

import random
from collections import Counter

import regex
from pyspark.sql import functions as F

from palimpsest.functions import identifiers as ids


def pairs(captures):
    return Counter((c.type, c.id) for c in captures)


def test_arxiv(apply):
    """New and old forms, after a parameter, a scheme or an address, with and without version."""
    expected = {
        "Preprint arxiv=1412.6980v9, later in print": ["1412.6980"],
        "(ArXiv: 2105.00001)": ["2105.00001"],
        "at http://arxiv.org/1801.04381 and again": ["1801.04381"],
        "https://arxiv.org/abs/1603.05027v3.": ["1603.05027"],
        "see https://arxiv.org/abs/hep-ph/0412012v2": ["hep-ph/0412012"],
        "Arxiv = cs.LG/0512099 |year=2005": ["cs.lg/0512099"],
        "arxiv:98765432": ["98765432"],
        "arxiv of papers, 1412.6980": [],
    }
    found = apply(ids.arxiv, list(expected))
    assert [[c.id for c in row] for row in found] == list(expected.values())
    for text, row in zip(expected, found, strict=True):
        assert all(text[c.begin : c.end].lower() == c.id for c in row)


def test_doi(apply):
    """Brackets stay while they balance; marks and closing tags end a DOI; repeats count."""
    text = (
        "Annals, 10.4242/vol.7-3, p. 5. Not one: 10.42 seconds.\n"
        "{{journal|doi=10.31415/pi(1)|pages=9}} <ref>doi:10.2718/e</ref>\n"
        "[https://doi.org/10.1618/phi(a[b]c)<d>] and [https://doi.org/10.1618/phi[x]]\n"
        "<!-- 10.4242/vol.7-3 --> 10.4242/vol.7-3"
    )
    (found,) = apply(ids.doi, [text])
    assert pairs(found) == Counter(
        {
            ("doi", "10.4242/vol.7-3"): 3,
            ("doi", "10.31415/pi(1)"): 1,
            ("doi", "10.2718/e"): 1,
            ("doi", "10.1618/phi(a[b]c)<d>"): 1,
            ("doi", "10.1618/phi[x]"): 1,
        }
    )
    assert all(text[c.begin : c.end] == c.id for c in found)


def test_doi_edges(apply):
    texts = {
        "10.1234/zero a 10.1234/one": ["10.1234/one"],
        "x doi=10.1000/ab(c)[d]e]f": ["10.1000/ab(c)[d]e"],
        "k 10.5555/c.d.,! z": ["10.5555/c.d"],
        "y 10.5555/b{q}}r": ["10.5555/b{q}"],
        " 10.1/a 10.1234/q<ref name='s'>": ["10.1234/q"],
        " 10.1234/a</ref >b": ["10.1234/a</ref"],
        " 10.1000/a]10.2000/b": ["10.1000/a", "10.2000/b"],
        " 10.1000/10.2000/b": ["10.1000/10.2000/b"],
        " 10.1234/": ["10.1234/"],
        " 10.1234/a;b;": ["10.1234/a;b;"],
    }
    found = apply(ids.doi, list(texts))
    assert [[c.id for c in f] for f in found] == list(texts.values())


def test_doi_overlap_rules(apply):
    texts = ["10.1234/zero a 10.1234/one", " 10.1234/a,10.5678/b"]
    every = apply(lambda t: ids.doi(t, overlap="all"), texts)
    assert [[c.id for c in f] for f in every] == [
        ["10.1234/zero", "10.1234/one"],
        ["10.1234/a,10.5678/b"],
    ]


STOP_TAGS = tuple(ids.DOI_STOP_TAGS.split("|"))


def scan_dois(text):
    """The DOI rules, one character at a time."""
    found, last, at = [], 0, 0

    def start_at(i):
        j = i + 3
        while j < len(text) and text[j] in "0123456789":
            j += 1
        return j + 1 if text[i : i + 3] == "10." and j - i >= 7 and text[j : j + 1] == "/" else 0

    def is_tag(i):
        for close in ("", "/", "/ "):
            for tag in STOP_TAGS:
                head = "<" + close + tag
                if text[i : i + len(head)].lower() != head:
                    continue
                rest = text[i + len(head) :]
                if rest[:1] == ">":
                    return True
                end = rest.find(">")
                if rest[:1].isspace() and end > 1 and not set("\n\r") & set(rest[1:end]):
                    return True
        return False

    while at < len(text):
        end = start_at(at)
        if not end:
            at += 1
            continue
        if at > last:
            i, square, curly = at, 0, 0
            while i < len(text):
                c = text[i]
                if c.isspace() or c in "|?#" or text.startswith(("<!--", "-->"), i) or is_tag(i):
                    break
                if c == "]" and not square or c == "}" and not curly:
                    break
                square += (c == "[") - (c == "]")
                curly += (c == "{") - (c == "}")
                i += 1
            id_ = text[at:i].rstrip(".,!")
            found.append((id_, at, at + len(id_)))
            last = at + len(id_)
        else:
            last = max(end, last)
        at = end
    return found


def test_doi_by_brute_force(apply):
    rng = random.Random(11)
    pieces = ["10.1234/", "10.56789/", "a", "]", "[", "{", "}", ".", ",", "!", "<ref>", "</ref>",
              "<b x>", "<x>", "<!--", "-->", "-", " ", "\n", "|", "?", "(", ")", "é", "😀", "1", "/ref>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(8000)]
    got = [[(c.id, c.begin, c.end) for c in f] for f in apply(ids.doi, texts)]
    expected = [scan_dois(t) for t in texts]
    assert sum(map(len, expected)) > 2000
    assert [x for x in zip(texts, got, expected) if x[1] != x[2]] == []


def test_patterns_match_as_in_another_engine(apply):
    """Ids and spans of the plain patterns, matched by the ``regex`` package."""
    old = rf"(?:{ids.ARXIV_ARCHIVE})?{ids.ARXIV_OLD_NUMBER}"
    arxiv = [
        rf"{prefix}(?:-?(?P<id>{old})|(?P<id>{ids.ARXIV_NEW_ID})(?:v[0-9]+)?)"
        for prefix in ids.ARXIV_PREFIXES
    ]
    around = ["", " ", "\n", "é", "x", "_", "|", "K"]
    between = ["", "=", " = ", "=\u00a0", ":", ": ", " "]
    cases = (  # extractor, plain patterns, leads, what follows them
        (ids.arxiv, arxiv, ["arxiv", "ArXiv", "//arxiv.org/", "//arxiv.org/abs/"],
         ["-", "ab", "K", ".", "/", "ı", "ſ", "\u212a", "1234", "56789", "0706.0001", "v1", "\n", "math.gt/", "abc/", "/cd/"]),
        (ids.isbn, [ids.ISBN], ["isbn", "ISBN", "iſbn", "ısbn", "İSBN"], ["12", "-", "X", "x", ":", "\n", "3"]),
        (ids.pmid, [ids.PMID_TEMPLATE, ids.PMID_URL],
         ["pmid", "PMID", "//www.ncbi.nlm.nih.gov/pubmed/"], ["pmc", "12", "3", "é", "_", "\n", " "]),
        (ids.pmc, [ids.PMC_TEMPLATE, ids.PMC_URL],
         ["pmc", "Pmc", "//www.ncbi.nlm.nih.gov/pmc/articles/PMC"], ["PMC", "12", "3", "é", "_", "\n", " "]),
    )
    rng = random.Random(21)
    for function, patterns, leads, pieces in cases:
        texts = [
            "".join(
                rng.choice(around) + rng.choice(leads) + rng.choice(between)
                + "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6)))
                for _ in range(rng.randrange(4))
            )
            for _ in range(5000)
        ]
        expected = []
        for text in texts:
            found = []
            for pattern in patterns:
                for match in regex.finditer(pattern, text, regex.I):
                    group = "id" if "id" in match.groupdict() else 1
                    id_ = match.group(group)
                    id_ = id_.lower() if function is ids.arxiv else id_
                    id_ = id_.replace("-", "") if function is ids.isbn else id_
                    found.append((id_, *match.span(group)))
            expected.append(found)
        got = [[(c.id, c.begin, c.end) for c in f] for f in apply(function, texts)]
        assert sum(map(len, expected)) > 100
        assert [x for x in zip(texts, got, expected) if x[1] != x[2]] == []


def test_long_words_are_linear(apply):
    texts = ["arxiv=" + "a" * 200_000, "arxiv=" + "a" * 100_000 + "/1234567", "pmid" + " " * 200_000]
    assert [[c.end - c.begin for c in f] for f in apply(ids.arxiv, texts)] == [[], [100_008], []]
    assert apply(ids.pmid, texts) == [[], [], []]


def test_isbn(apply):
    (found,) = apply(ids.isbn, ["ISBN 0-19-853453-1 isbn=978X ISBN: 99 isbn=-"])
    assert [c.id for c in found] == ["0198534531", "978X", ""]
    assert [(c.begin, c.end) for c in found] == [(5, 18), (24, 28), (43, 44)]


def test_pubmed(apply):
    """Parameters need a number that ends there; addresses may have either scheme."""
    text = (
        "pmid = 204418, PMID=31|x {{a|pmid=77}} pmid=12b nopmid=40 "
        "https://www.ncbi.nlm.nih.gov/pubmed/9001 "
        "pmc=PMC555 |pmc = 812 }} http://www.ncbi.nlm.nih.gov/pmc/articles/PMC6060"
    )
    (pmid,), (pmc,) = apply(ids.pmid, [text]), apply(ids.pmc, [text])
    assert [c.id for c in pmid] == ["204418", "31", "77", "9001"]
    assert [c.id for c in pmc] == ["555", "812", "6060"]
    assert all(text[c.begin : c.end] == c.id for c in [*pmid, *pmc])


def test_all_identifiers_keep_duplicates(apply):
    text = " isbn=1 isbn=1 pmc=2 pmid=3 doi=10.1000/x arxiv=0706.0001"
    (found,) = apply(ids.publication_identifiers, [text])
    assert [(c.type, c.id) for c in found] == [
        ("arxiv", "0706.0001"), ("doi", "10.1000/x"), ("isbn", "1"), ("isbn", "1"),
        ("pmid", "3"), ("pmc", "2"),
    ]
    assert apply(lambda t: ids.publication_identifiers(t, []), [text]) == [[]]


def test_own_extractor(apply):
    import pandas as pd

    @F.pandas_udf(ids.CAPTURES)
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: [{"type": "word", "id": t[:3], "begin": 0, "end": min(3, len(t))}]
        )

    (found,) = apply(lambda t: F.concat(words(t), ids.isbn(t)), ["abc isbn=5"])
    assert [(c.type, c.id) for c in found] == [("word", "abc"), ("isbn", "5")]


def test_one_pass_finds_what_the_extractors_find(spark):
    texts = [
        None,
        "",
        "arxiv=isbn=x/12345 pmid = pmc12",
        "arxiv:arxiv=abc/123456 //arxiv.org/abs/math.GT/0309001v1 ISBN 1-2",
        "arXİv: 1510.1234/x PMC=PMC7 pmİd=8 10.1000/isbn12|Iſbn=3 arxiv=1501.10010.1234/y",
        "//www.ncbi.nlm.nih.gov/pmc/articles/PMC9 //WWW.ncbi.nlm.nih.gov/pubmed/10 pmc=1pmid=2",
    ]
    each = F.concat(*[extract(F.col("text")) for extract in ids.EXTRACTORS.values()])
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        ids.publication_identifiers(F.col("text")).alias("found"), each.alias("expected")
    )
    for row in rows.collect():
        assert row.found == row.expected
