"""Arrow batches cut to a bounded size of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame


def slices(
    batches: Iterator[pa.RecordBatch], text: str, size: int = 2 << 20, rows: int = 4096
) -> Iterator[pa.RecordBatch]:
    """Slices of some ``size`` bytes of ``text`` at most, unless a single text has more."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, done + size, side="right"))
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def input_bytes(rows: DataFrame) -> int:
    """The optimizer's estimate of the size of ``rows``: for files what they hold; 0 if unknown."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def bucket_count(rows: DataFrame, size: int) -> int:
    """Buckets of some ``size`` bytes of input each, at least one for each shuffle partition."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-input_bytes(rows) // size))
