"""Joins in which a missing key equals a missing key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; keys are compared with NULL equal to NULL."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), how)
    return joined.drop(*(f"_right_{key}" for key in keys))
