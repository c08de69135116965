"""Session defaults and the shared working folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings that the operators rely on, or that pay off for long texts.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Call-site capture for every column expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(
    name: str, master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with ``DEFAULTS``; master and partition count come from the cluster if unset.

    The number of shuffle partitions has to suit the input, which only the caller knows.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Functions that run in workers import it; workers need not have it installed.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        with tempfile.TemporaryDirectory() as folder:
            copy = Path(folder) / "copy"
            shutil.copytree(
                package, copy / package.name, ignore=shutil.ignore_patterns("__pycache__")
            )
            keep = tempfile.mkdtemp(prefix="palimpsest-package-")
            context.addPyFile(shutil.make_archive(f"{keep}/{package.name}", "zip", copy))
        _shipped.add(context.applicationId)


_local_folders: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster must name one.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="palimpsest-")
    return _local_folders[application]


def staged(rows: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``rows`` once to the working folder and read them back.

    A job derives features and counters from the same captures.  Staging the captures, which
    are far smaller than the texts, keeps that to one pass over the texts, and nothing is
    lost with an executor.
    """
    spark = rows.sparkSession
    path = f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path, compression=compression)
    return spark.read.schema(rows.schema).parquet(path)
