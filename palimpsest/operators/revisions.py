"""Row filters and projections on revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import strip_comments
from palimpsest.model import ARTICLE_NAMESPACE, HISTORY_BLOCK, page_key
from palimpsest.operators.joins import null_safe_join


def articles(revisions: DataFrame) -> DataFrame:
    """Revisions of article pages; other namespaces are left out before any text work."""
    return revisions.where(F.col("ns") == ARTICLE_NAMESPACE)


def with_last_flag(
    rows: DataFrame, revisions: DataFrame | None = None, block: int = HISTORY_BLOCK
) -> DataFrame:
    """Add ``is_last`` where the source did not.

    The last position of each page comes from the narrow columns of ``revisions``, combined
    before the shuffle.  Call this on extracted rows rather than on rows that still carry
    texts: the join moves ``rows``.  It is keyed by page and block of positions, with the
    last position repeated per block, so that a page with a long history is spread out.
    """
    if "is_last" in rows.columns:
        return rows
    page = page_key(rows)
    blocks = F.sequence(F.lit(0), F.floor(F.col("_last_pos") / block).cast("int"))
    last = (
        (rows if revisions is None else revisions)
        .groupBy(*page)
        .agg(F.max("rev_pos").alias("_last_pos"))
        .select(*page, "_last_pos", F.explode(blocks).alias("_block"))
    )
    keyed = rows.withColumn("_block", F.floor(F.col("rev_pos") / block).cast("int"))
    return null_safe_join(keyed, last, [*page, "_block"]).select(
        *rows.columns, (F.col("rev_pos") == F.col("_last_pos")).alias("is_last")
    )


def last_revisions(revisions: DataFrame) -> DataFrame:
    """The last revision of each page, in file order."""
    return with_last_flag(revisions).where("is_last")


#: Bits of the map of last positions: 8 MB for each task, whatever the number of pages.
LAST_BITS = 1 << 26
BITMAP_BITS = 1 << 15  # of one bitmap, as the bitmap functions have it


def likely_last(revisions: DataFrame, bits: int = LAST_BITS) -> DataFrame:
    """The last revision of each page and some others, without moving a text.

    Last positions come from the narrow columns.  Their hashes set bits of a map of a fixed size,
    which every task gets, and rows whose bit is not set are left out where they are read.  With
    8 million pages some 12 % of the other revisions stay; ``exactly_last`` drops them later.
    """
    if "is_last" in revisions.columns:
        return revisions.where("is_last")
    place = F.pmod(F.xxhash64(*page_key(revisions), "rev_pos"), F.lit(bits))
    last = revisions.groupBy(*page_key(revisions)).agg(F.max("rev_pos").alias("rev_pos"))
    # The bitmap functions count from 1.
    numbered = last.select((place + 1).alias("place"))
    maps = numbered.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    every = revisions.sparkSession.range(1, bits // BITMAP_BITS + 1).withColumnRenamed("id", "bucket")
    listed = F.sort_array(F.collect_list(F.struct("bucket", "bits")))
    table = every.join(maps, "bucket", "left").agg(listed.alias("maps")).select("maps.bits").scalar()
    bitmap = F.get(table, F.floor(place / BITMAP_BITS).cast("int"))
    byte = F.substring(bitmap, F.floor(place % BITMAP_BITS / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
    return revisions.where(F.coalesce(is_set, F.lit(False)))


def scoped(revisions: DataFrame, only_last: bool) -> DataFrame:
    """What to extract from; with ``only_last`` the result needs ``exactly_last``."""
    return likely_last(revisions) if only_last else revisions


def exactly_last(rows: DataFrame, revisions: DataFrame, only_last: bool) -> DataFrame:
    """Extracted ``rows`` of last revisions, if these are wanted."""
    return with_last_flag(rows, revisions).where("is_last") if only_last else rows


def with_clean_text(revisions: DataFrame) -> DataFrame:
    """``text`` without HTML comments; a missing text reads as empty."""
    return revisions.withColumn("text", strip_comments(F.col("text")))


def find_page(revisions: DataFrame, title: str) -> DataFrame:
    """Revisions of the page with exactly this title."""
    return revisions.where(F.col("page_title") == title)


# How contributors without an account, or without a record, are written.
NO_USER = ("None", "None", -2)
IP_USER_ID = -1


def contributor(user: Column) -> list[Column]:
    """``user_type``, ``user_username`` and ``user_id`` of a contributor."""
    kind, name, number = NO_USER
    missing, known = user.isNull(), user["id"].isNotNull()
    return [
        F.when(missing, kind).when(known, "registered").otherwise("ip").alias("user_type"),
        F.when(missing, name).otherwise(user["text"]).alias("user_username"),
        F.when(missing, F.lit(number).cast("bigint"))
        .when(known, user["id"])
        .otherwise(F.lit(IP_USER_ID).cast("bigint"))
        .alias("user_id"),
    ]


def minor_flag(minor: Column) -> Column:
    return F.coalesce(minor.cast("int"), F.lit(0))


def iso_timestamp(ts: Column) -> Column:
    """ISO 8601 text in UTC, whatever the session's time zone."""
    seconds = F.unix_seconds(ts)
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    rest = F.pmod(seconds, F.lit(86400))

    def two_digits(value: Column) -> Column:
        return F.lpad(F.floor(value).cast("string"), 2, "0")

    clock = [two_digits(rest / 3600), two_digits(rest % 3600 / 60), two_digits(rest % 60)]
    return F.concat(day.cast("string"), F.lit("T"), F.concat_ws(":", *clock), F.lit("Z"))
