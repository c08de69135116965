import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from palimpsest.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", master="local[*]", shuffle_partitions=8)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Apply a column function to each of some texts."""

    def run(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
        found = rows.select("n", function(F.col("text")).alias("x")).orderBy("n").collect()
        return [row.x for row in found]

    return run
