"""Sections, references, templates and internal links of a wikitext column.

All functions expect comment-stripped text (``text.strip_comments``) and return arrays of
structs with half-open code-point offsets ``begin`` and ``end``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import languages
from palimpsest.functions.arrays import let, prefix_max
from palimpsest.functions.text import locate_all, strip_blanks, up_to_last

# The wikitext constructs.  (?d) keeps "." and "$" to "\n" alone and (?U) makes
# "\s" Unicode-aware.
HEADER = r"(?mdU)^(=+)(.+?)\1\s*$"
REFERENCE = r"(?is)<ref.*?</ref>"
TEMPLATE = r"(?s)\{\{.*?\}\}"
WIKILINK = r"\[\[([^\n\|\]\[#<>{}]{0,256}+)(?:\|([^\[]*?))?\]\]"
LAST_REFERENCE_END = r"(?is)^.*</ref>"
INCIPIT = "---~--- incipit ---~---"


def _headers(text: Column, tail: bool = True) -> Column:
    """Header lines with name, level and the text up to the next header."""
    return F.transform(
        locate_all(text, HEADER, tail=tail),
        lambda h: F.struct(
            h["begin"].alias("begin"),
            F.regexp_extract(h["raw"], HEADER, 2).alias("name"),
            F.length(F.regexp_extract(h["raw"], HEADER, 1)).alias("level"),
            *([h["tail"].alias("tail")] if tail else []),
        ),
    )


def sections(
    text: Column, include_preamble: bool = False, compat: bool = False, bodies: bool = True
) -> Column:
    """``array<struct<number, name, level[, body], begin, end>>`` in text order.

    A section ends at the newline before the next header.  Names are not trimmed; numbers
    start at 1.  ``include_preamble`` prepends number 0, level 0 for the text before the
    first header.  When a header stands at offset 0 that preamble has the span (0, -1) and an
    empty body; ``compat`` gives it the text without its last character instead.  Without
    ``bodies`` there is no ``body``, and no text is copied.
    """

    def build(t: Column, headers: Column) -> Column:
        named = F.transform(
            headers,
            lambda h, i: let(
                F.get(headers, i + 1)["begin"],
                lambda following: F.struct(
                    (i + 1).cast("int").alias("number"),
                    h["name"].alias("name"),
                    h["level"].alias("level"),
                    *([_body(h["tail"], following.isNotNull()).alias("body")] if bodies else []),
                    h["begin"].alias("begin"),
                    F.coalesce(following - 1, F.length(t)).alias("end"),
                ),
            ),
        )
        if not include_preamble:
            return named

        def before(end: Column) -> Column:
            size = F.when(end < 0, F.length(t) + end).otherwise(end) if compat else end
            return F.substring(t, F.lit(1), size)

        preamble = let(
            F.coalesce(F.get(headers, F.lit(0))["begin"] - 1, F.length(t)),
            lambda end: F.struct(
                F.lit(0).alias("number"),
                F.lit("").alias("name"),
                F.lit(0).alias("level"),
                *([before(end).alias("body")] if bodies else []),
                F.lit(0).alias("begin"),
                end.alias("end"),
            ),
        )
        return F.concat(F.array(preamble), named)

    return let(text, lambda t: let(_headers(t, bodies), lambda h: build(t, h)))


def _body(tail: Column, followed: Column) -> Column:
    size = F.length(tail)
    return F.when(followed, F.substring(tail, F.lit(2), size - 2)).otherwise(
        F.substring(tail, F.lit(2), size)
    )


def section_names(text: Column) -> Column:
    """Raw section names in text order (no bodies, one pass over the text)."""
    return F.regexp_extract_all(text, F.lit(HEADER), F.lit(2))


def is_preamble(section: Column) -> Column:
    return section["level"] == 0


def full_body(section: Column) -> Column:
    """Header line plus body; the body alone for the preamble."""
    equals = F.repeat(F.lit("="), section["level"])
    return F.when(is_preamble(section), section["body"]).otherwise(
        F.concat(equals, section["name"], equals, F.lit("\n"), section["body"])
    )


def references(text: Column, raw: bool = True) -> Column:
    """``<ref ... </ref>`` spans, case-insensitive and across lines."""
    return locate_all(F.regexp_extract(text, LAST_REFERENCE_END, 0), REFERENCE, raw=raw)


def templates(text: Column, raw: bool = True) -> Column:
    """``{{ ... }}`` spans, across lines; nesting is not followed."""
    return locate_all(up_to_last(text, "}}"), TEMPLATE, raw=raw)


def citations(text: Column, language: str) -> Column:
    """Templates whose name is one of the language's citation words."""
    words = "|".join(languages.citation_terms(language))
    return locate_all(up_to_last(text, "}}"), rf"(?sU)\{{\{{\s*(?:{words})\s+.*?\}}\}}")


def wikilinks(text: Column) -> Column:
    """``array<struct<link, anchor, begin, end>>`` of internal links."""

    def parse(match: Column) -> Column:
        def resolve(link: Column) -> Column:
            shown = F.regexp_extract(match["raw"], WIKILINK, 2)
            anchor = strip_blanks(
                F.replace(F.when(shown == "", link).otherwise(shown), F.lit("\n"), F.lit(" "))
            )
            return let(
                anchor,
                lambda a: F.struct(
                    F.when(link == "", a).otherwise(link).alias("link"),
                    a.alias("anchor"),
                    match["begin"].alias("begin"),
                    match["end"].alias("end"),
                ),
            )

        return let(strip_blanks(F.regexp_extract(match["raw"], WIKILINK, 1)), resolve)

    return F.transform(locate_all(text, WIKILINK), parse)


def sectioned_wikilinks(text: Column) -> Column:
    """Internal links with the section each one starts in.

    Sections tile the text from the first header on, so a link belongs to the last header at
    or before it.  Links and headers are sorted together by offset and the header number is
    carried forward, instead of comparing every link with every section.
    """

    def join(links: Column, headers: Column) -> Column:
        marks = F.sort_array(
            F.concat(
                F.transform(
                    headers,
                    lambda h, i: F.struct(
                        h["begin"].alias("at"),
                        (i + 1).cast("int").alias("section"),
                        F.lit(-1).alias("link"),
                    ),
                ),
                F.transform(
                    links,
                    lambda x, i: F.struct(
                        x["begin"].alias("at"), F.lit(0).alias("section"), i.cast("int").alias("link")
                    ),
                ),
            )
        )

        def carry(sorted_marks: Column) -> Column:
            current = prefix_max(F.transform(sorted_marks, lambda m: m["section"]))
            placed = F.filter(
                F.zip_with(
                    sorted_marks,
                    current,
                    lambda m, s: F.struct(m["link"].alias("link"), s.alias("section")),
                ),
                lambda m: m["link"] >= 0,
            )
            return F.transform(placed, attach)

        def attach(mark: Column) -> Column:
            link = F.get(links, mark["link"])
            header = F.get(headers, mark["section"] - 1)
            return F.struct(
                link["link"].alias("link"),
                link["anchor"].alias("anchor"),
                link["begin"].alias("begin"),
                link["end"].alias("end"),
                F.coalesce(header["name"], F.lit(INCIPIT)).alias("section_name"),
                F.coalesce(header["level"], F.lit(0)).alias("section_level"),
                mark["section"].alias("section_number"),
            )

        return let(marks, carry)

    def find(t: Column) -> Column:
        return let(wikilinks(t), lambda links: let(_headers(t), lambda h: join(links, h)))

    return let(text, find)
