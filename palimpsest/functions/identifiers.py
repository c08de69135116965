"""Publication identifiers: arXiv, DOI, ISBN, PubMed and PubMed Central.

An extractor maps a comment-stripped text column to
``array<struct<type, id, begin, end>>``; ``begin`` and ``end`` cover the identifier itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.arrays import let
from palimpsest.functions.text import locate_all

Extractor = Callable[[Column], Column]

CAPTURES = "array<struct<type:string,id:string,begin:int,end:int>>"

# The identifier patterns.
ARXIV_PREFIXES = (r"arxiv\s*=\s*", r"//arxiv\.org/(?:abs/)?", r"arxiv:\s?")
ARXIV_ARCHIVE = r"[a-z]+.[a-z]+/"
ARXIV_OLD_NUMBER = r"[0-9]{4}[0-9]+"
ARXIV_NEW_ID = r"[0-9]{4}.[0-9]+"
DOI_START = r"10\.[0-9]{4,}/"
DOI_STOP_TAGS = "ref|span|div|table|h1|h2|h3|h4|h5|h6|b|u|i|s|ins|del|code|tt|blockquote|pre"
DOI_TRAILING = r"[.,!]+$"
ISBN = r"isbn\s?=?\s?([0-9\-Xx]+)"
PMID_TEMPLATE = r"\bpmid\s*=\s*(?:pmc)?([0-9]+)\b"
PMID_URL = r"//www\.ncbi\.nlm\.nih\.gov/pubmed/([0-9]+)\b"
PMC_TEMPLATE = r"\bpmc\s*=\s*(?:pmc)?([0-9]+)\b"
PMC_URL = r"//www\.ncbi\.nlm\.nih\.gov/pmc/articles/PMC([0-9]+)\b"


def ignore_case(pattern: str) -> str:
    """``pattern`` for any case, with Unicode classes and "." up to a line feed.

    Java folds the dotless i with "i", which the patterns do not mean: "i" and letter ranges
    are spelled out.
    """
    pattern = pattern.replace("[a-z]", "(?-i:[a-zA-Z\\u0130\\u017F\\u212A])").replace(
        "[^a-z\\n]", "(?-i:[^a-zA-Z\\u0130\\u017F\\u212A\\n])"
    )
    parts = re.split(r"(\(\?-i:[^)]*\))", pattern)
    parts[::2] = [part.replace("i", "(?-i:[iI\\u0130])") for part in parts[::2]]
    return "(?iudU)" + "".join(parts)


# The archive part matches the same as ``ARXIV_ARCHIVE`` without its backtracking, which is
# quadratic on long words: the free character is either behind the first word or inside it.
ARXIV_OLD_ID = rf"(?:[a-z]++[^a-z\n][a-z]++/|[a-z]{{3,}}+/)?{ARXIV_OLD_NUMBER}"

# A DOI runs from its start to white space, "|", "?", "#", a known tag or a comment mark.
# The quantifiers are possessive: each branch consumes what no other branch could.
# A start without flags is a plain literal to the matcher, which finds it faster.
DOI_RUN = DOI_START + ignore_case(
    r"(?:[^\s|?#<\-]++"
    + rf"|<(?!(?:/\s*)?(?:{DOI_STOP_TAGS})(?:\s[^>\n\r]+)?>|!--)"
    + r"|-(?!->))*+"
)


def _word_first(pattern: str) -> str:
    """The same pattern with a leading ``\\bword`` tested as ``word``, then the boundary.

    A Unicode word boundary at every character of the text costs more than all the rest.
    """
    return re.sub(r"^\\b(\w+)", r"\1(?<=\\b\1)", pattern)


def _capture(kind: str, id_: Column, begin: Column, end: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"), id_.alias("id"), begin.alias("begin"), end.alias("end")
    )


def _if_contains(text: Column, literal: str, found: Column) -> Column:
    """``found`` where the text holds a lower-case literal in any case, else nothing.

    A plain search costs far less than a pattern.  The literals are parts of the patterns
    without "i", "k" and "s", to which other letters fold.
    """
    return F.when(F.contains(F.lower(text), F.lit(literal)), found).otherwise(
        F.array().cast(CAPTURES)
    )


def _arxiv_pattern(prefix: str) -> str:
    # A pattern that opens with a group is slower to find than its bare form.
    return f"{prefix}(?:-?{ARXIV_OLD_ID}|{ARXIV_NEW_ID}(?:v[0-9]+)?)"


def _arxiv_capture(match: Column, prefix: str) -> Column:
    pattern = ignore_case(f"({prefix})(?:(-?)({ARXIV_OLD_ID})|({ARXIV_NEW_ID})(?:v[0-9]+)?)")
    raw = match["raw"]
    lead = F.length(F.regexp_extract(raw, pattern, 1)) + F.length(F.regexp_extract(raw, pattern, 2))
    # Only one of the two forms takes part; the other group is empty.
    id_ = F.concat(F.regexp_extract(raw, pattern, 4), F.regexp_extract(raw, pattern, 3))
    return let(
        id_,
        lambda i: _capture(
            "arxiv", F.lower(i), match["begin"] + lead, match["begin"] + lead + F.length(i)
        ),
    )


def arxiv(text: Column) -> Column:
    """arXiv identifiers, lower-cased and without version, one pass per prefix."""

    def by_prefix(t: Column, prefix: str) -> Column:
        matches = locate_all(t, ignore_case(_arxiv_pattern(prefix)))
        return F.transform(matches, lambda match: _arxiv_capture(match, prefix))

    def find(t: Column) -> Column:
        found = [
            _if_contains(t, literal, by_prefix(t, prefix))
            for prefix, literal in zip(ARXIV_PREFIXES, ("arx", "//arx", "v:"), strict=True)
        ]
        return _if_contains(t, "arx", F.concat(*found))

    return let(text, find)


def _balanced_length(text: Column) -> Column:
    """Length of the text before the first "]" or "}" that closes nothing."""
    start = F.struct(
        F.lit(0).alias("seen"),
        F.lit(0).alias("square"),
        F.lit(0).alias("curly"),
        F.lit(False).alias("done"),
    )

    def step(state: Column, char: Column) -> Column:
        done = (
            state["done"]
            | ((char == "]") & (state["square"] == 0))
            | ((char == "}") & (state["curly"] == 0))
        )
        square = F.when(char == "[", 1).when(char == "]", -1).otherwise(0)
        curly = F.when(char == "{", 1).when(char == "}", -1).otherwise(0)
        return F.when(
            done,
            F.struct(
                state["seen"].alias("seen"),
                state["square"].alias("square"),
                state["curly"].alias("curly"),
                F.lit(True).alias("done"),
            ),
        ).otherwise(
            F.struct(
                (state["seen"] + 1).alias("seen"),
                (state["square"] + square).alias("square"),
                (state["curly"] + curly).alias("curly"),
                F.lit(False).alias("done"),
            )
        )

    return F.aggregate(F.split(text, ""), start, step, lambda s: s["seen"])


def _cut_at_unbalanced(run: Column) -> Column:
    """``run`` up to its first unbalanced closing bracket."""

    def cut(plain: Column) -> Column:
        follows = F.substring(run, F.length(plain) + 1, F.lit(1))
        return F.when(follows.isin("[", "{"), F.substring(run, F.lit(1), _balanced_length(run))).otherwise(
            plain
        )

    return let(F.regexp_extract(run, r"^[^\[\]{}]*+", 0), cut)


def doi(text: Column, overlap: str = "skip") -> Column:
    """DOIs with bracket balancing and trailing ".,!" removed.

    With ``overlap='skip'`` a start counts only behind the end of the previous DOI, where the
    first "previous end" is offset 0: a DOI at offset 0, or one that begins exactly where the
    previous one ended, is skipped.  ``overlap='all'`` takes these too.

    A run of DOI characters is cut out first, so that the bracket walk sees short strings
    only.  Runs are at least one character apart, hence the rule applies within each run, and
    a run with a single start needs no walk over starts.
    """
    if overlap not in ("skip", "all"):
        raise ValueError("overlap must be 'skip' or 'all'")
    found = "array<struct<id:string,begin:int,end:int>>"

    def single(run: Column) -> Column:
        only = let(
            F.regexp_replace(_cut_at_unbalanced(run["raw"]), DOI_TRAILING, ""),
            lambda id_: F.array(
                F.struct(
                    id_.alias("id"),
                    run["begin"].alias("begin"),
                    (run["begin"] + F.length(id_)).alias("end"),
                )
            ),
        )
        if overlap == "all":
            return only
        return F.when(run["begin"] > 0, only).otherwise(F.array().cast(found))

    def in_run(run: Column) -> Column:
        return F.when(F.locate("10.", run["raw"], 2) == 0, single(run)).otherwise(several(run))

    def several(run: Column) -> Column:
        first_end = F.when(run["begin"] == 0, 0).otherwise(-1) if overlap == "skip" else F.lit(-1)
        zero = F.struct(first_end.alias("last"), F.array().cast(found).alias("out"))

        def step(state: Column, start: Column) -> Column:
            def take(kept: Column) -> Column:
                id_ = F.regexp_replace(kept, DOI_TRAILING, "")
                last = start["begin"] + F.length(id_ if overlap == "skip" else kept)
                if overlap == "all":
                    last = last - 1
                return F.struct(
                    last.alias("last"),
                    F.concat(
                        state["out"],
                        F.array(
                            F.struct(
                                id_.alias("id"),
                                (run["begin"] + start["begin"]).alias("begin"),
                                (run["begin"] + start["begin"] + F.length(id_)).alias("end"),
                            )
                        ),
                    ).alias("out"),
                )

            taken = let(
                _cut_at_unbalanced(
                    F.substring(run["raw"], start["begin"] + 1, F.length(run["raw"]))
                ),
                take,
            )
            passed = F.struct(
                (F.greatest(start["end"], state["last"]) if overlap == "skip" else state["last"]).alias(
                    "last"
                ),
                state["out"].alias("out"),
            )
            return F.when(start["begin"] > state["last"], taken).otherwise(passed)

        return F.aggregate(locate_all(run["raw"], DOI_START), zero, step, lambda s: s["out"])

    def find(t: Column) -> Column:
        dois = F.flatten(F.transform(locate_all(t, DOI_RUN), in_run))
        captures = F.transform(dois, lambda d: _capture("doi", d["id"], d["begin"], d["end"]))
        return F.when(F.contains(t, F.lit("10.")), captures).otherwise(F.array().cast(CAPTURES))

    return let(text, find)


def _trailing_group(
    text: Column, kind: str, pattern: str, literal: str, drop: str = ""
) -> Column:
    """Captures of a pattern whose group 1 is the end of the match; it holds ``literal``."""
    pattern = ignore_case(_word_first(pattern))

    def parse(match: Column) -> Column:
        return _trailing_capture(match, kind, F.regexp_extract(match["raw"], pattern, 1), drop)

    return _if_contains(text, literal, F.transform(locate_all(text, pattern), parse))


def _trailing_capture(match: Column, kind: str, group: Column, drop: str = "") -> Column:
    return let(
        group,
        lambda g: _capture(
            kind,
            F.replace(g, F.lit(drop), F.lit("")) if drop else g,
            match["end"] - F.length(g),
            match["end"],
        ),
    )


def isbn(text: Column) -> Column:
    """ISBNs without dashes; the span covers the dashed form; no check digit test."""
    return let(text, lambda t: _trailing_group(t, "isbn", ISBN, "bn", drop="-"))


def pmid(text: Column) -> Column:
    """PubMed ids from template arguments, then from links."""
    return let(
        text,
        lambda t: F.concat(
            _trailing_group(t, "pmid", PMID_TEMPLATE, "pm"),
            _trailing_group(t, "pmid", PMID_URL, ".nlm."),
        ),
    )


def pmc(text: Column) -> Column:
    """PubMed Central ids from template arguments, then from links."""
    return let(
        text,
        lambda t: F.concat(
            _trailing_group(t, "pmc", PMC_TEMPLATE, "pmc"),
            _trailing_group(t, "pmc", PMC_URL, ".nlm."),
        ),
    )


EXTRACTORS: dict[str, Extractor] = {
    "arxiv": arxiv,
    "doi": doi,
    "isbn": isbn,
    "pmid": pmid,
    "pmc": pmc,
}


# Everything but DOIs in one pattern.  No two of its parts match at one place, and only an arXiv
# archive can hold the start of another match (``INNER_START``, behind the first character).
WORDED = "(?=[aAiI\\u0130pP/])(?iudU)(?:" + "|".join(
    ignore_case(pattern).removeprefix("(?iudU)")
    for pattern in (
        _arxiv_pattern(ARXIV_PREFIXES[0]),
        _arxiv_pattern(ARXIV_PREFIXES[2]),
        _word_first(ISBN),
        _word_first(PMID_TEMPLATE),
        _word_first(PMC_TEMPLATE),
        _arxiv_pattern(ARXIV_PREFIXES[1]),
        PMID_URL,
        PMC_URL,
    )
) + ")"
INNER_START = "(?s)^..*?" + ignore_case(r"(?:isbn|arxiv\s*[=:])")
# The last group of all of them but arXiv: nothing that precedes it ends in one of its letters.
LAST_GROUP = r"[0-9\-Xx]+$"


def _kind(raw: Column) -> Column:
    """Which part of ``WORDED`` a match is of, numbered in the order of the extractors.

    Letters are matched one by one, so places tell; no other letter folds to those compared.
    """

    def at(place: int, letters: str) -> Column:
        return F.substring(raw, place, 1).isin(*letters)

    url = F.when(at(3, "aA"), 2).when(at(25, "uU"), 6).otherwise(8)
    return (
        F.when(at(1, "iI\u0130"), 4)
        .when(at(1, "pP"), F.when(at(3, "cC"), 7).otherwise(5))
        .when(at(1, "aA"), F.when(at(6, ":"), 3).otherwise(1))
        .otherwise(url)
    )


def _all_identifiers(text: Column) -> Column:
    """What all extractors find, in their order, in two passes over the text instead of ten."""

    def parse(match: Column) -> Column:
        kind = match["kind"]

        def trailing(name: str, drop: str = "") -> Column:
            return _trailing_capture(match, name, F.regexp_extract(match["raw"], LAST_GROUP, 0), drop)

        prefixes = "|".join(ARXIV_PREFIXES)
        return (
            F.when(kind == 4, trailing("isbn", drop="-"))
            .when(kind <= 3, _arxiv_capture(match, prefixes))
            .when(kind <= 6, trailing("pmid"))
            .otherwise(trailing("pmc"))
        )

    def ordered(t: Column, matches: Column) -> Column:
        def of(kind: int) -> Column:
            return F.transform(F.filter(matches, lambda m: m["kind"] == kind), parse)

        return F.concat(*map(of, (1, 2, 3)), doi(t), *map(of, (4, 5, 6, 7, 8)))

    def find(t: Column) -> Column:
        matches = F.transform(
            locate_all(t, WORDED),
            lambda m: F.struct(
                _kind(m["raw"]).alias("kind"),
                m["raw"].alias("raw"),
                m["begin"].alias("begin"),
                m["end"].alias("end"),
            ),
        )
        nested = lambda m: (m["kind"] <= 3) & m["raw"].rlike(INNER_START)
        return let(
            matches,
            lambda found: F.when(
                F.exists(found, nested), F.concat(*[extract(t) for extract in EXTRACTORS.values()])
            ).otherwise(ordered(t, found)),
        )

    return let(F.coalesce(text, F.lit("")), find)


def publication_identifiers(
    text: Column, extractors: Iterable[Extractor] | None = None
) -> Column:
    """Bag union of all extractors, in order, duplicates kept.

    Pass ``extractors`` to use other functions of the same shape, Arrow UDFs included.
    """
    if extractors is None:
        return _all_identifiers(text)
    chosen = tuple(extractors)
    if not chosen:
        return F.array().cast(CAPTURES)
    return let(text, lambda t: F.concat(*[extract(t) for extract in chosen]))
