"""The ``revisions`` table every operator starts from.

One row per page revision.  ``rev_pos`` is the 0-based place of the revision in its page in
file order; it is dense.  Two columns are optional, because a reader that sees whole pages
gets them for nothing while others would pay a shuffle: ``is_last`` (last revision of the
page in file order) and ``chrono_pos`` (dense place in ``(ts, rev_id)`` order).

A third optional column, ``page_ordinal``, is the place of the page in its file.  The readers of
dumps give it.  Where it is there, it is a part of the page's key, so that pages of one id in one
file are told apart; else the id has to be unique in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ARTICLE_NAMESPACE = 0

USER = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("text", T.StringType())]
)

REVISIONS = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("ns", T.IntegerType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("rev_pos", T.IntegerType()),
        T.StructField("rev_id", T.LongType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user", USER),
        T.StructField("minor", T.BooleanType()),
        T.StructField("comment", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
IS_LAST = T.StructField("is_last", T.BooleanType())
CHRONO_POS = T.StructField("chrono_pos", T.IntegerType())

# Split of the file and record in the split where the page begins.
PAGE_ORDINAL = T.StructField(
    "page_ordinal",
    T.StructType([T.StructField("split", T.LongType()), T.StructField("record", T.LongType())]),
)

# Page ids are unique within one dump file at most.
PAGE_KEY = ("source_file", "page_id")


def page_key(rows: DataFrame) -> list[str]:
    """The columns that tell pages apart."""
    return [*PAGE_KEY, *([PAGE_ORDINAL.name] if PAGE_ORDINAL.name in rows.columns else [])]


# Rows of one page that a history operator may keep in one group.
HISTORY_BLOCK = 10_000
