"""Comparing each revision of a page with the one before it.

A page may hold any share of all revisions, so no operator groups by page alone.  Positions
inside a page are dense, which lets a page be cut into blocks of ``HISTORY_BLOCK`` rows; the
last row of a block is also sent to the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.model import HISTORY_BLOCK, page_key
from palimpsest.operators.joins import null_safe_join

# The two kinds of change.
ADDED = "added"
REMOVED = "removed"


def identifier_key(identifier: Column) -> Column:
    """``type:id`` as one string, so that array set operations can hash it."""
    return F.concat(identifier["type"], F.lit(":"), identifier["id"])


def key_type(key: Column) -> Column:
    return F.substring_index(key, ":", 1)


def key_id(key: Column) -> Column:
    return F.substring(key, F.length(key_type(key)) + 2, F.length(key))


def with_chronological_position(rows: DataFrame) -> DataFrame:
    """Add ``chrono_pos``, the dense place of a revision in its page by ``(ts, rev_id)``.

    Revisions are counted per page and hour first; an hour's rows are then ranked on their
    own and shifted by the count of all earlier hours.  Revisions without a timestamp come
    first, as an hour of their own.  A page has at most some 200,000
    hours, so the second window stays small however many revisions the page has.
    """
    if "chrono_pos" in rows.columns:
        return rows
    hourly = rows.withColumn("_hour", F.floor(F.unix_seconds("ts") / 3600))
    page = page_key(rows)
    page_hour = [*page, "_hour"]
    earlier_hours = (
        Window.partitionBy(*page).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        hourly.groupBy(*page_hour)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*page_hour, F.coalesce(F.sum("_n").over(earlier_hours), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy(*page_hour).orderBy("ts", "rev_id"))
    return null_safe_join(hourly, offsets, page_hour).select(
        *rows.columns, (F.col("_before") + rank - 1).cast("int").alias("chrono_pos")
    )


def with_previous(
    rows: DataFrame, value: str, position: str, block: int = HISTORY_BLOCK
) -> DataFrame:
    """Add ``previous``, the ``value`` of the row before in the page, and ``block``.

    One shuffle by page and block.  Only the last row of a full block is copied.
    """
    place = F.col(position)
    number = F.floor(place / block).cast("int")
    at_home = F.struct(number.alias("block"), F.lit(False).alias("copied"))
    ahead = F.struct((number + 1).alias("block"), F.lit(True).alias("copied"))
    targets = F.when(place % block == block - 1, F.array(at_home, ahead)).otherwise(
        F.array(at_home)
    )
    order = Window.partitionBy(*page_key(rows), "block").orderBy(position)
    return (
        rows.select(*rows.columns, F.inline(targets))
        .withColumn("previous", F.lag(value).over(order))
        .where(~F.col("copied"))
        .drop("copied")
    )


def changes(current: Column, previous: Column) -> Column:
    """``array<struct<action, item>>``: items added first, then removed, each sorted.

    Repeated items count once.
    """

    def tagged(items: Column, action: str) -> Column:
        return F.transform(
            F.sort_array(items), lambda x: F.struct(F.lit(action).alias("action"), x.alias("item"))
        )

    before = F.coalesce(previous, F.array().cast("array<string>"))
    return F.concat(
        tagged(F.array_except(current, before), ADDED),
        tagged(F.array_except(before, current), REMOVED),
    )


def with_changes(
    rows: DataFrame,
    items: str,
    position: str = "rev_pos",
    only_last: bool = False,
    block: int = HISTORY_BLOCK,
) -> DataFrame:
    """Add ``changes`` of the ``items`` array against the previous revision.

    With ``only_last`` there is one revision per page and everything in it is new.
    """
    if only_last:
        nothing = F.array().cast("array<string>")
        return rows.withColumn("changes", changes(F.col(items), nothing))
    compared = with_previous(rows, items, position, block)
    return compared.withColumn("changes", changes(F.col(items), F.col("previous"))).drop("previous")


def one_per_change(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per change: ``columns``, ``action`` and ``item``.

    An inner ``inline`` would make the optimizer test the size of ``changes`` in a filter of
    its own, and so compute them twice.
    """
    return rows.select(*columns, F.inline_outer("changes")).where(F.col("action").isNotNull())


def lifespans(rows: DataFrame, items: str = "ids", block: int = HISTORY_BLOCK) -> DataFrame:
    """Intervals in which an item is present in a page, in ``(ts, rev_id)`` order.

    ``rows`` needs the page key, ``page_title``, ``rev_id``, ``ts`` and the ``items`` array.
    An interval runs from the revision that adds the item to the one that removes it;
    ``removed_ts`` is NULL while the item is still there.

    Additions and removals are paired within a block first.  Only what is left open at block
    edges, at most two rows per item and block, is paired across blocks.
    """
    placed = with_chronological_position(rows)
    page = page_key(rows)
    events = one_per_change(
        with_changes(placed, items, "chrono_pos", block=block),
        *page,
        "page_title",
        "block",
        "chrono_pos",
        "ts",
    )
    in_block = Window.partitionBy(*page, "block", "item").orderBy("chrono_pos")
    paired = events.select(
        *page,
        "page_title",
        "item",
        "action",
        "chrono_pos",
        "ts",
        "block",
        F.lead("ts").over(in_block).alias("_next_ts"),
        F.lag("action").over(in_block).alias("_opened"),
    ).where((F.col("action") == ADDED) | F.col("_opened").isNull())
    # Closed pairs stay apart by block; open ends of one item meet in lane -1.
    lane = F.when(
        (F.col("action") == ADDED) & F.col("_next_ts").isNotNull(), F.col("block")
    ).otherwise(-1)
    across = Window.partitionBy(*page, "item", "_lane").orderBy("chrono_pos")
    return (
        paired.withColumn("_lane", lane)
        .withColumn("_later_ts", F.when(F.col("_lane") < 0, F.lead("ts").over(across)))
        .where(F.col("action") == ADDED)
        .select(
            *page,
            "page_title",
            F.col("item"),
            F.col("ts").alias("added_ts"),
            F.coalesce("_next_ts", "_later_ts").alias("removed_ts"),
        )
    )
