"""Relations between spans of one text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import identifiers, wikitext
from palimpsest.functions.arrays import let, let_sql
from palimpsest.functions.matching import is_bibliography

SectionFilter = Callable[[Column], Column]

# Where an identifier can appear.
IN_BOTH = "in_tag_ref_and_template"
IN_TEMPLATE = "only_in_template"
IN_REFERENCE = "only_in_tag_ref"
IN_SECTION = "only_in_filtered_sections"
IN_RAW_TEXT = "only_in_raw_text"
APPEARANCES = (IN_RAW_TEXT, IN_REFERENCE, IN_TEMPLATE, IN_BOTH, IN_SECTION)


# Comparing a pair of spans costs about this fraction of a step of the sorted sweep.
PAIRS_PER_MARK = 50


def contained(points: Column, intervals: Column) -> Column:
    """For each of ``points``, whether its span lies in any interval (ends inclusive).

    Long arrays are sorted together by offset; an interval that starts at or before a point
    contains it when the furthest end seen so far reaches the point's end.  This takes
    n log n steps where testing all pairs takes n * m, which is only cheaper while few.
    """

    pairs = """
        transform(both.points, p ->
          exists(both.intervals, c -> c.begin <= p.begin AND p.`end` <= c.`end`))"""
    marks = """
        sort_array(concat(
          transform(both.intervals, c -> named_struct('at', c.begin, 'point', -1, 'end', c.`end`)),
          transform(both.points, (p, i) -> named_struct('at', p.begin, 'point', i, 'end', p.`end`))))"""
    reach = """
        aggregate(
          sequence(0, length(bin(size(marks))) - 1),
          transform(marks, m -> CASE WHEN m.point < 0 THEN m.`end` END),
          (reach, k) -> transform(
            reach, (r, i) -> greatest(r, get(reach, i - shiftleft(1, k)))))"""
    sweep = f"""
        get(transform(array({marks}), marks ->
          transform(
            sort_array(filter(
              zip_with(marks, {reach}, (m, r) ->
                named_struct('point', m.point, 'inside', coalesce(m.`end` <= r, false))),
              m -> m.point >= 0)),
            m -> m.inside)), 0)"""
    return let_sql(
        F.struct(points.alias("points"), intervals.alias("intervals")),
        f"""both -> CASE
          WHEN bigint(size(both.points)) * size(both.intervals)
            <= (bigint(size(both.points)) + size(both.intervals)) * {PAIRS_PER_MARK}
          THEN {pairs} ELSE {sweep} END""",
    )


def section_filter(kind: str | None, language: str | None = None) -> SectionFilter | None:
    """The section test for a filter name: ``None`` keeps all, or ``'bibliography'``."""
    if not kind:
        return None
    if kind != "bibliography":
        raise NotImplementedError(f"section filter {kind!r} is not implemented")
    if not language:
        raise ValueError("the bibliography section filter needs a language")

    def by_name(section: Column) -> Column:
        return is_bibliography(section["name"], language)

    by_name.reads_body = False
    return by_name


def appearance(in_references: Column, in_templates: Column, in_sections: Column) -> Column:
    """The class of places an identifier was found in."""
    return (
        F.when(in_templates & in_references, IN_BOTH)
        .when(in_templates, IN_TEMPLATE)
        .when(in_references, IN_REFERENCE)
        .when(in_sections, IN_SECTION)
        .otherwise(IN_RAW_TEXT)
    )


def located_identifiers(
    text: Column,
    keep_section: SectionFilter | None = None,
    extractors: list[identifiers.Extractor] | None = None,
) -> Column:
    """Identifiers with the kinds of span that contain them.

    ``array<struct<type, id, begin, end, in_references, in_templates, in_sections,
    appearance>>``; sections include the preamble and are those ``keep_section`` accepts.  A
    filter with the attribute ``reads_body`` set to False gets sections without a body.
    """
    bodies = keep_section is not None and getattr(keep_section, "reads_body", True)

    def relate(t: Column, found: Column) -> Column:
        kept = wikitext.sections(t, include_preamble=True, bodies=bodies)
        if keep_section is not None:
            kept = F.filter(kept, keep_section)
        places = F.arrays_zip(
            contained(found, wikitext.references(t, raw=False)).alias("references"),
            contained(found, wikitext.templates(t, raw=False)).alias("templates"),
            contained(found, kept).alias("sections"),
        )
        return F.zip_with(
            found,
            places,
            lambda f, p: F.struct(
                f["type"].alias("type"),
                f["id"].alias("id"),
                f["begin"].alias("begin"),
                f["end"].alias("end"),
                p["references"].alias("in_references"),
                p["templates"].alias("in_templates"),
                p["sections"].alias("in_sections"),
                appearance(p["references"], p["templates"], p["sections"]).alias("appearance"),
            ),
        )

    none = F.array().cast(
        "array<struct<type:string,id:string,begin:int,end:int,in_references:boolean,"
        "in_templates:boolean,in_sections:boolean,appearance:string>>"
    )
    return let(
        text,
        lambda t: let(
            identifiers.publication_identifiers(t, extractors),
            lambda found: F.when(F.size(found) == 0, none).otherwise(relate(t, found)),
        ),
    )
