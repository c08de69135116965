"""Staged revisions as a stream.

The reference work is batch only.  Extraction is a projection of single rows, so the link job
also runs on a stream as it is; comparing revisions stays a batch task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palimpsest.model import REVISIONS
from palimpsest.plans import wikilinks


def revision_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of revisions, as they are added to ``folder``."""
    return spark.readStream.schema(REVISIONS).parquet(folder)


def append_wikilinks(
    revisions: DataFrame, language: str, output: str, checkpoint: str
) -> StreamingQuery:
    """Append the links of all revisions that are there, then stop; run again for more."""
    return (
        wikilinks.features(revisions, language)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
