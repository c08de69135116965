"""Whole-text helpers: comment removal, trimming, and locating pattern matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.arrays import let, let_sql

# What counts as an HTML comment, and as blank when trimming.
COMMENT = r"(?s)<!--.*?-->"
BLANK_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def up_to_last(text: Column, closer: str) -> Column:
    """The text up to and including the last ``closer``; empty when there is none.

    A lazy ``open.*?close`` pattern rescans to the end of the text for every opener that is
    never closed.  Cutting at the last closer first leaves it linear.
    """
    return let(
        text,
        lambda t: F.substring(t, 1, F.length(t) - F.length(F.substring_index(t, closer, -1))),
    )


def strip_comments(text: Column) -> Column:
    """Remove HTML comments, across lines; an unterminated comment stays.  NULL reads as ''."""

    def strip(t: Column) -> Column:
        closed = up_to_last(t, "-->")
        cleaned = F.concat(
            F.regexp_replace(closed, COMMENT, ""), F.substring_index(t, "-->", -1)
        )
        return F.when(F.contains(t, F.lit("<!--")), cleaned).otherwise(t)

    return let(F.coalesce(text, F.lit("")), strip)


def strip_blanks(text: Column) -> Column:
    """Trim Unicode white space from both ends."""
    return F.regexp_replace(text, BLANK_EDGES, "")


def _sql_string(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def locate_all(text: Column, pattern: str, tail: bool = False, raw: bool = True) -> Column:
    """Every match of ``pattern`` as ``array<struct<[raw, ]begin, end[, tail]>>``.

    ``begin`` and ``end`` are half-open code-point offsets.  They come from the lengths of
    the pieces between matches, which costs one more pass over texts that do match and
    nothing on texts that do not.  The lengths are summed up in log2(n) passes: adding to an
    array one by one would copy it n times.  ``tail`` is the text between a match and the
    next one.  Without ``raw`` only the offsets are kept, which copies no text.
    """
    if tail and not raw:
        raise ValueError("tail comes with raw")
    p = _sql_string(pattern)
    fields = ("raw:string," if raw else "") + "begin:int,end:int" + (",tail:string" if tail else "")
    kept = "'raw', raw, " if raw else ""
    spans = f"""
        zip_with(matches, ends, (raw, last) ->
          named_struct({kept}'begin', last - length(raw), 'end', last))"""
    if tail:
        spans = f"""
        transform({spans}, (m, i) -> named_struct(
          'raw', m.raw, 'begin', m.begin, 'end', m.`end`, 'tail', get(pieces, i + 1)))"""
    ends = """
        aggregate(
          sequence(0, length(bin(size(matches))) - 1),
          zip_with(slice(pieces, 1, size(matches)), matches, (gap, raw) -> length(gap) + length(raw)),
          (sums, k) -> transform(
            sums, (s, i) -> s + coalesce(get(sums, i - shiftleft(1, k)), 0)))"""
    return let_sql(
        text,
        f"""t -> get(transform(array(regexp_extract_all(t, {p}, 0)), matches ->
          CASE WHEN size(matches) = 0 THEN CAST(array() AS array<struct<{fields}>>)
          ELSE get(transform(array(split(t, {p}, -1)), pieces ->
            get(transform(array({ends}), ends -> {spans}), 0)), 0) END), 0)""",
    )
