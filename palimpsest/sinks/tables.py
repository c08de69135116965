"""CSV and parquet outputs, one folder per source file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.revisions import iso_timestamp

COMPRESSIONS = (None, "gzip")
PAGES_PER_FILE = 100_000


def check_compression(compression: str | None) -> str | None:
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be None or 'gzip', not {compression!r}")
    return compression


def write_nowhere(rows: DataFrame) -> None:
    """Compute every row and write none."""
    rows.write.format("noop").mode("overwrite").save()


def source_name(source_file: Column) -> Column:
    """The folder name of a source's output: the file's own name, without where it lay."""
    return F.coalesce(F.regexp_extract(source_file, "([^/]*)/*$", 1), F.lit("unknown"))


def _by_source(rows: DataFrame) -> DataFrame:
    return rows.withColumn("source_file", source_name(F.col("source_file")))


def write_csv(
    rows: DataFrame, path: str, header: bool, compression: str | None = None
) -> None:
    """CSV with the columns in order; timestamps as ISO 8601, NULL as an empty field.

    With ``header`` every part file has a header line.
    """
    columns = [
        iso_timestamp(F.col(f"`{field.name}`")).alias(field.name)
        if field.dataType.typeName() == "timestamp"
        else F.col(f"`{field.name}`")
        for field in rows.schema.fields
    ]
    writer = (
        _by_source(rows.select(*columns))
        .write.option("header", header)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", check_compression(compression) or "none")
        .partitionBy("source_file")
    )
    writer.csv(path)


def write_wikilinks(links: DataFrame, path: str, compression: str | None = None) -> None:
    """Fourteen columns, named in a header line."""
    names = {c: c.replace("wikilink_", "wikilink.", 1) for c in links.columns}
    write_csv(links.withColumnsRenamed(names), path, header=True, compression=compression)


def write_page_ids(pages: DataFrame, path: str, compression: str | None = None) -> None:
    write_csv(pages, path, header=False, compression=compression)


def write_lifespans(spans: DataFrame, path: str, compression: str | None = None) -> None:
    """Dealt out by source and block of pages, which keeps files few; rows have no order."""
    dealt = spans.repartition("source_file", F.floor(F.col("page_id") / PAGES_PER_FILE))
    write_csv(dealt, path, header=False, compression=compression)
