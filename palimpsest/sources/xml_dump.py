"""MediaWiki XML history dumps (export schema 0.10) as DataFrames.

A dump file is one XML document of any size.  The readers cut it into records at a tag,
which splits large and bz2-compressed files over many tasks, and parse each record with
``from_xml``.  Markup inside texts is escaped, so a raw tag is never part of a text.

Two ways to read revisions, both with ``is_last`` and with ``page_ordinal``, by which pages of one
id in a file are told apart:

* ``read_revisions``: a record is a revision.  Works for pages of any length.
* ``read_whole_pages``: a record is a page.  Gives ``chrono_pos`` as well, without a shuffle,
  but a page with its whole history has to fit into one record.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.arrays import let
from palimpsest.model import ARTICLE_NAMESPACE
from palimpsest.session import staged

# The element names and types of the export schema.
REVISION_ELEMENT = (
    "id bigint, parentid bigint, timestamp timestamp,"
    " contributor struct<username:string,id:bigint,ip:string,_deleted:string>,"
    " minor string, comment string, model string, format string, text string"
)
PAGE_HEAD_ELEMENT = "title string, ns int, id bigint"
SITEINFO_ELEMENT = (
    "sitename string, dbname string, base string, generator string, `case` string,"
    " namespaces struct<namespace:array<struct<_key:int,_case:string,_VALUE:string>>>"
)
# Surrounding blanks belong to the text: spans count from its first character.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}

# Largest number of file splits whose page carry-over is sent to every task at once (some 100
# bytes each, 400 at most).  More splits are read as several groups of files.
MAX_BROADCAST_SPLITS = 500_000


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _chunks(spark: SparkSession, paths: str | Iterable[str], tag: str) -> DataFrame:
    """Pieces of the files between occurrences of ``tag``, with the file and its split."""
    return (
        spark.read.option("lineSep", tag)
        .text(_paths(paths))
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("split"),
        )
    )


def _parse(xml: Column, schema: str) -> Column:
    return F.from_xml(xml, schema, XML_OPTIONS)


def _wrap(tag: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), content, F.lit(f"</{tag}>"))


def _revision_columns(revision: Column) -> list[Column]:
    who = revision["contributor"]
    name = F.coalesce(who["username"], who["ip"])
    return [
        revision["id"].alias("rev_id"),
        revision["parentid"].alias("parent_id"),
        revision["timestamp"].alias("ts"),
        F.when(
            who["id"].isNotNull() | name.isNotNull(),
            F.struct(who["id"].alias("id"), name.alias("text")),
        ).alias("user"),
        revision["minor"].isNotNull().alias("minor"),
        revision["comment"].alias("comment"),
        revision["model"].alias("model"),
        revision["format"].alias("format"),
        revision["text"].alias("text"),
    ]


def read_siteinfo(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per file: site name, case rule and namespaces."""
    chunks = _chunks(spark, paths, "</page>").where(F.contains("value", F.lit("<siteinfo>")))
    content = F.substring_index(
        F.substring_index(F.col("value"), "</siteinfo>", 1), "<siteinfo>", -1
    )
    # Other records are not parsed even where a plan works this out ahead of the filter.
    content = F.when(F.contains("value", F.lit("<siteinfo>")), content)
    site = _parse(_wrap("siteinfo", content), SITEINFO_ELEMENT)
    return chunks.select("source_file", site.alias("site")).select(
        "source_file",
        F.col("site.sitename").alias("sitename"),
        F.col("site.dbname").alias("dbname"),
        F.col("site.base").alias("base"),
        F.col("site.generator").alias("generator"),
        F.col("site.case").alias("case"),
        F.transform(
            "site.namespaces.namespace",
            lambda n: F.struct(
                n["_key"].alias("key"), n["_case"].alias("case"), n["_VALUE"].alias("name")
            ),
        ).alias("namespaces"),
    )


def read_pages(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per page, pages without revisions included: ``has_revisions`` tells."""
    chunks = _chunks(spark, paths, "<revision>").where(F.contains("value", F.lit("<page>")))
    # What follows a page head in its record is either the end of the page or a revision.
    return (
        chunks.select("source_file", F.split("value", "<page>", -1).alias("heads"))
        .select("source_file", F.explode(F.slice("heads", 2, F.size("heads"))).alias("head"))
        .select(
            "source_file",
            (~F.contains("head", F.lit("</page>"))).alias("has_revisions"),
            _page_head(F.col("head")).alias("page"),
        )
        .select(
            "source_file",
            F.col("page.id").alias("page_id"),
            F.col("page.ns").alias("ns"),
            F.col("page.title").alias("page_title"),
            "has_revisions",
        )
    )


def _page_head(head: Column) -> Column:
    return _parse(_wrap("page", F.substring_index(head, "</page>", 1)), PAGE_HEAD_ELEMENT)


def read_whole_pages(
    spark: SparkSession, paths: str | Iterable[str], articles_only: bool = False
) -> DataFrame:
    """Revisions, page by page, with ``is_last`` and ``chrono_pos``.

    ``articles_only`` drops other namespaces before the XML is parsed.
    """
    chunks = _chunks(spark, paths, "</page>").where(F.contains("value", F.lit("<page>")))
    if articles_only:
        chunks = chunks.where(F.contains("value", F.lit(f"<ns>{ARTICLE_NAMESPACE}</ns>")))
    schema = f"{PAGE_HEAD_ELEMENT}, revision array<struct<{_colons(REVISION_ELEMENT)}>>"
    page = _parse(_wrap("page", F.substring_index(F.col("value"), "<page>", -1)), schema)
    ordinal = F.struct("split", F.monotonically_increasing_id().alias("record")).alias("page_ordinal")
    return (
        chunks.select("source_file", ordinal, page.alias("page"))
        .select("source_file", "page_ordinal", "page", F.inline(_with_positions(F.col("page.revision"))))
        .select(
            "source_file",
            F.col("page.id").alias("page_id"),
            "page_ordinal",
            F.col("page.ns").alias("ns"),
            F.col("page.title").alias("page_title"),
            "rev_pos",
            *_revision_columns(F.col("revision")),
            "is_last",
            "chrono_pos",
        )
    )


def _colons(fields: str) -> str:
    """DDL columns as struct fields."""
    return ", ".join(part.strip().replace(" ", ":", 1) for part in fields.split(", "))


def _with_positions(revisions: Column) -> Column:
    """Each revision with its place in the file and in ``(timestamp, id)`` order."""

    def number(items: Column) -> Column:
        in_time = F.sort_array(
            F.transform(
                items,
                lambda r, i: F.struct(
                    r["timestamp"].alias("ts"), r["id"].alias("id"), i.cast("int").alias("pos")
                ),
            )
        )
        places = F.sort_array(
            F.transform(
                in_time,
                lambda r, k: F.struct(r["pos"].alias("pos"), k.cast("int").alias("chrono_pos")),
            )
        )
        return F.zip_with(
            items,
            places,
            lambda r, p: F.struct(
                r.alias("revision"),
                p["pos"].alias("rev_pos"),
                (p["pos"] == F.size(items) - 1).alias("is_last"),
                p["chrono_pos"].alias("chrono_pos"),
            ),
        )

    return let(revisions, number)


def read_revisions(
    spark: SparkSession, paths: str | Iterable[str], articles_only: bool = False
) -> DataFrame:
    """Revisions, one record each, with ``is_last``.

    A record runs from one ``<revision>`` tag to the next, so it also holds what stands
    between: the end of the page, if it was the last revision, and the head of the next page.
    Within a file split, page heads are carried forward to the revisions that follow; a small
    table with one row per split, built from the page heads alone, carries them over to the
    next splits.  Texts are read in place and never shuffled: the table is broadcast, for so
    many files at once as keep it small.  That table is built when this function is called.
    """
    chunks = _headed_chunks(spark, paths)
    carry = staged(_carry_over(chunks), "page-carry")
    groups = max(1, -(-carry.count() // MAX_BROADCAST_SPLITS))
    if groups == 1:
        placed = _placed(chunks, carry)
    else:
        # How files are split depends on which of them are read, so each group has its own table.
        parts = [_file_group(chunks, k, groups) for k in range(groups)]
        placed = reduce(
            DataFrame.unionByName, [_placed(p, staged(_carry_over(p), "page-carry")) for p in parts]
        )
    if articles_only:
        placed = placed.where(F.col("ns") == ARTICLE_NAMESPACE)
    content = F.substring_index(F.col("value"), "</revision>", 1)
    keys = ["source_file", "page_id", "page_ordinal", "ns", "page_title", "rev_pos"]
    return placed.select(
        *keys,
        _parse(_wrap("revision", content), REVISION_ELEMENT).alias("revision"),
        F.contains("value", F.lit("</page>")).alias("is_last"),
    ).select(*keys, *_revision_columns(F.col("revision")), "is_last")


def _file_group(rows: DataFrame, number: int, groups: int) -> DataFrame:
    """The rows of a share of the files; other files are not opened."""
    return rows.where(F.pmod(F.xxhash64("source_file"), F.lit(groups)) == number)


def _placed(chunks: DataFrame, carry: DataFrame) -> DataFrame:
    """Revision records with their page and their place in it."""
    filled = chunks.mapInArrow(_carry_forward(), _filled_schema(chunks.schema))
    page = F.coalesce(F.col("page"), F.col("before"))
    in_split = F.col("page").isNotNull()
    return (
        filled.where(F.contains("value", F.lit("</revision>")))
        .join(F.broadcast(carry), ["source_file", "split"], "left")
        .select(
            "source_file",
            page["id"].alias("page_id"),
            F.when(in_split, F.struct("split", F.col("head").alias("record")))
            .otherwise(F.col("begun"))
            .alias("page_ordinal"),
            page["ns"].alias("ns"),
            page["title"].alias("page_title"),
            F.when(in_split, F.col("place"))
            .otherwise(F.col("place") + F.coalesce("rows_before", F.lit(0)))
            .cast("int")
            .alias("rev_pos"),
            "value",
        )
    )


def _headed_chunks(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Records with the page head they end with, if any; it belongs to the next record."""
    chunks = _chunks(spark, paths, "<revision>")
    head = F.when(
        F.contains("value", F.lit("<page>")),
        _page_head(F.substring_index(F.col("value"), "<page>", -1)),
    )
    return chunks.select("source_file", "split", head.alias("page"), "value")


def _filled_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema.fields, T.StructField("place", T.LongType()), T.StructField("head", T.LongType())]
    )


def _carry_forward() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The fill below as a local function: it travels to the workers whole, package or not."""

    def carry_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give each record the last page head before it in the same split.

        ``place`` counts the records since that head, ``head`` those of the split before it.
        Records before the first head of a split keep a NULL page, and count from the split's
        start.  Only the narrow columns are looked at; texts pass through as Arrow buffers.
        """
        # Of the next record, if it is in the same split; and how many the split had so far.
        split, page, place, head, count = None, None, 0, -1, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            heads = batch.column("page")
            splits = list(
                zip(batch.column("source_file").to_pylist(), batch.column("split").to_pylist())
            )
            rows = np.arange(n)
            opens = np.fromiter((a != b for a, b in zip(splits, [split, *splits[:-1]])), bool, n)
            after_head = np.zeros(n, bool)
            after_head[1:] = heads.is_valid().to_numpy(zero_copy_only=False)[:-1]
            # Counting starts anew in a new split and behind a head; else it goes on.
            start = np.maximum.accumulate(np.where(opens | after_head, rows, -1))
            goes_on = start < 0
            places = np.where(goes_on, place + rows, rows - start)
            # The page comes from the record before the start, from the batch before, or is open.
            source = np.where(goes_on, n, np.where(opens[start] & ~goes_on, n + 1, start - 1))
            choices = pa.concat_arrays([heads, pa.array([page, None], type=heads.type)])
            pages = choices.take(pa.array(source))
            begin = np.maximum.accumulate(np.where(opens, rows, -1))
            number = np.where(begin < 0, count + rows, rows - begin)
            of_head = np.append(number, (head, -1))[source]
            split, count = splits[-1], int(number[-1]) + 1
            if heads[n - 1].is_valid:
                page, place, head = heads[n - 1].as_py(), 0, int(number[-1])
            else:
                page, place, head = pages[n - 1].as_py(), int(places[-1]) + 1, int(of_head[-1])
            columns = [pages if name == "page" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(places, type=pa.int64()), pa.array(of_head, type=pa.int64())],
                names=[*batch.schema.names, "place", "head"],
            )

    return carry_forward


def _carry_over(chunks: DataFrame) -> DataFrame:
    """For each split that starts inside a page: that page and its records so far."""
    ordered = chunks.select(
        "source_file", "split", "page", F.monotonically_increasing_id().alias("row")
    )
    headed_row = F.when(F.col("page").isNotNull(), F.col("row"))
    splits = ordered.groupBy("source_file", "split").agg(
        F.max_by("page", headed_row).alias("page"),
        F.max(headed_row).alias("head_row"),
        F.max("row").alias("last_row"),
        F.min("row").alias("first_row"),
        F.count(F.lit(1)).alias("n"),
    )
    in_file = Window.partitionBy("source_file").orderBy("split")
    upto = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # A split without a head adds all its records to the page that is still open.
    counted = splits.select(
        "source_file",
        "split",
        "page",
        F.when(
            F.col("head_row").isNotNull(),
            F.struct("split", (F.col("head_row") - F.col("first_row")).alias("record")),
        ).alias("begun"),
        F.coalesce(F.col("last_row") - F.col("head_row"), F.col("n")).alias("open"),
        F.count("head_row").over(upto).alias("run"),
    )
    in_run = Window.partitionBy("source_file", "run").orderBy("split").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = counted.withColumn("open_records", F.sum("open").over(in_run))
    return summed.select(
        "source_file",
        "split",
        F.last("page", ignorenulls=True).over(earlier).alias("before"),
        F.last("begun", ignorenulls=True).over(earlier).alias("begun"),
        F.lag("open_records").over(in_file).alias("rows_before"),
    ).where(F.col("before").isNotNull())
