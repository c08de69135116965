"""Sections, references, templates and links on known texts."""

import random

import regex

from palimpsest.functions import wikitext
from palimpsest.functions.text import locate_all, strip_blanks, strip_comments


def spans(items):
    return [(x.raw, x.begin, x.end) for x in items]


def test_strip_comments(apply):
    texts = ["a<!-- x\ny -->b<!--c", None, "", "<!---->", "<!-->-->x", "-->a<!--b-->c--><!--"]
    assert apply(strip_comments, texts) == ["ab<!--c", "", "", "", "x", "-->ac--><!--"]


def test_strip_blanks(apply):
    texts = ["  a b \n", "\x1ca\x1f", "", " "]
    assert apply(strip_blanks, texts) == ["a b", "a", "", ""]


def test_locate_all_offsets_are_code_points(apply):
    (found,) = apply(lambda t: locate_all(t, r"\[[^\]]*\]", tail=True), ["😀[é]ü😀[b][]x"])
    assert [(x.raw, x.begin, x.end, x.tail) for x in found] == [
        ("[é]", 1, 4, "ü😀"),
        ("[b]", 6, 9, ""),
        ("[]", 9, 11, "x"),
    ]


def test_sections(apply):
    text = "Lead\n\n= Heading 1 =\nbody one\nmore\n\n== Heading 2 ==\ntwo\n three\n"
    (found,) = apply(wikitext.sections, [text])
    assert [(s.number, s.name, s.level, s.body) for s in found] == [
        (1, " Heading 1 ", 1, "body one\nmore\n"),
        (2, " Heading 2 ", 2, "two\n three\n"),
    ]
    assert all(0 <= s.begin <= s.end <= len(text) for s in found)


def test_section_edges(apply):
    texts = ["== A =", "====", "= A =\n\n\n  x", "= A =", "=======H7=======", "x\n=A=\n=B=\nz", "a = b ="]
    found = apply(wikitext.sections, texts)
    assert [[(s.level, s.name, s.body) for s in f] for f in found] == [
        [(1, "= A ", "")],
        [(1, "==", "")],
        [(1, " A ", "  x")],
        [(1, " A ", "")],
        [(7, "H7", "")],
        [(1, "A", ""), (1, "B", "z")],
        [],
    ]
    assert (found[3][0].begin, found[3][0].end) == (0, 5)


def test_preamble(apply):
    texts = ["p\n= A =\nb", "=A=\nx", "none", ""]
    plain = apply(lambda t: wikitext.sections(t, include_preamble=True), texts)
    assert [(f[0].level, f[0].name, f[0].body, f[0].begin, f[0].end) for f in plain] == [
        (0, "", "p", 0, 1),
        (0, "", "", 0, -1),
        (0, "", "none", 0, 4),
        (0, "", "", 0, 0),
    ]
    compat = apply(lambda t: wikitext.sections(t, include_preamble=True, compat=True), texts)
    assert [f[0].body for f in compat] == ["p", "=A=\n", "none", ""]


def test_full_body(apply):
    from pyspark.sql import functions as F

    (found,) = apply(
        lambda t: F.transform(wikitext.sections(t, include_preamble=True), wikitext.full_body),
        ["lead\n== A ==\nb\n=C=\nd"],
    )
    assert found == ["lead", "== A ==\nb", "=C=\nd"]


def test_references(apply):
    texts = [
        "<ref name=x />foo<ref>a</REF>",
        "<ref a=\"b\" c='d' e='f\"g\"'>t</ref>",
        "<ref>1</ref>\n<ref>2</ref>\n<ref>",
        "<ref n>\n* {{cite|a}}\n</ref>",
        "nothing",
    ]
    assert [spans(f) for f in apply(wikitext.references, texts)] == [
        [(texts[0], 0, len(texts[0]))],
        [(texts[1], 0, len(texts[1]))],
        [("<ref>1</ref>", 0, 12), ("<ref>2</ref>", 13, 25)],
        [(texts[3], 0, len(texts[3]))],
        [],
    ]


def test_templates(apply):
    texts = ["{{a\n|b}} {{c {{d}} e}}", "{{\n\n x \n| y\n= z }}", "{{a {{b", "}}"]
    assert [spans(f) for f in apply(wikitext.templates, texts)] == [
        [("{{a\n|b}}", 0, 8), ("{{c {{d}}", 9, 18)],
        [(texts[1], 0, len(texts[1]))],
        [],
        [],
    ]


def test_citations(apply):
    (found,) = apply(
        lambda t: wikitext.citations(t, "en"), ["{{cite web|x}} {{Cite no}} {{ vcite\n y}} {{Citation}}"]
    )
    assert [x.raw for x in found] == ["{{cite web|x}}", "{{ vcite\n y}}"]


def test_wikilinks(apply):
    texts = [
        "[[a]] [[b|c]] [[|d]] [[]] [[e#f|g]] [[h|i\nj]]",
        "[[File:x|thumb|[[in|n]] cap]]",
        "[[ a | b ]] [[c| ]]",
        "[[" + "x" * 257 + "]] [[" + "y" * 256 + "]]",
    ]
    found = apply(wikitext.wikilinks, texts)
    assert [[(x.link, x.anchor) for x in f] for f in found] == [
        [("a", "a"), ("b", "c"), ("d", "d"), ("", ""), ("h", "i j")],
        [("in", "n")],
        [("a", "b"), ("c", "")],
        [("y" * 256, "y" * 256)],
    ]


def test_sectioned_wikilinks(apply):
    text = "[[p]]\n== S ==\n[[q]]\n\n=T=\n[[r]][[s| ]]"
    (found,) = apply(wikitext.sectioned_wikilinks, [text])
    assert [(x.link, x.section_name, x.section_level, x.section_number) for x in found] == [
        ("p", "---~--- incipit ---~---", 0, 0),
        ("q", " S ", 2, 1),
        ("r", "T", 1, 2),
        ("s", "T", 1, 2),
    ]


def random_texts(pieces, n, size, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_patterns_match_as_in_another_engine(apply):
    """The same constructs, matched by the ``regex`` package on random strings."""
    cases = (
        (wikitext.REFERENCE, r"(?is)<ref.*?</ref>", ["<ref", ">", "</ref>", "</REF>", " ", "é", "\n", "/"], wikitext.references),
        (wikitext.TEMPLATE, r"(?s)\{\{.*?\}\}", ["{", "}", "{{", "}}", "a", "\n", "😀"], wikitext.templates),
        (wikitext.HEADER, r"(?m)^(=+)(.+?)\1\s*$", ["=", "==", "a", " ", "\n", " ", "\r", "b"], None),
        (
            wikitext.WIKILINK,
            r"\[\[([^\n\|\]\[\#\<\>\{\}]{0,256})(?:\|([^\[]*?))?\]\]",
            ["[", "]", "[[", "]]", "|", "a", "\n", "#", " "],
            None,
        ),
    )
    for ours, theirs, pieces, function in cases:
        texts = random_texts(pieces, 1500, 24, seed=5)
        function = function or (lambda t, p=ours: locate_all(t, p))
        got = [spans(f) for f in apply(function, texts)]
        expected = [
            [(m.group(), m.start(), m.end()) for m in regex.finditer(theirs, t)] for t in texts
        ]
        assert got == expected
        assert any(expected)


def test_links_in_sections_by_brute_force(apply):
    texts = random_texts(["\n= a =\n", "\n==b==\n", "[[x]]", "[[y|z]]", "word ", "[[q|\n=c=\n]]"], 300, 40, seed=9)
    got = apply(wikitext.sectioned_wikilinks, texts)
    for text, found in zip(texts, got):
        headers = [m.start() for m in regex.finditer(r"(?m)^(=+)(.+?)\1\s*$", text)]
        assert [x.section_number for x in found] == [
            sum(h <= x.begin for h in headers) for x in found
        ]
        assert [x.begin for x in found] == sorted(x.begin for x in found)


def test_section_properties(apply):
    texts = random_texts(["\n= a =\n", "\n==b==", "text", "\n", " ", "é"], 300, 30, seed=3)
    for text, found in zip(texts, apply(wikitext.sections, texts)):
        for one, following in zip(found, found[1:]):
            assert one.end == following.begin - 1
        for s in found:
            assert text[s.begin :].startswith("=" * s.level + s.name + "=" * s.level)
            assert s.body in text
        if found:
            assert found[-1].end == len(text)
