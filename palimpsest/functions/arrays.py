"""Small building blocks over array columns.

Every function takes and returns a ``Column``; the work stays inside the row, so none of
them needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound name.

    An expression that is written twice, or inside a lambda, is evaluated each time it is
    reached.  Binding it as the only element of an array makes it a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_sql(value: Column, lambda_sql: str) -> Column:
    """``let`` with the body as a SQL lambda ``name -> expression``.

    For bodies of many small steps that are built often: one call to the JVM parses the text,
    where the column API makes several for each step.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(lambda_sql)), F.lit(0))


def prefix_scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive scan of an array with an associative ``combine``.

    Runs in log2(n) passes of n steps.  A fold that appends to an array copies the array at
    every step, which is quadratic on revisions with tens of thousands of links.
    ``combine`` gets NULL as its second argument where there is no left neighbour.
    """

    def scan(array: Column) -> Column:
        passes = F.sequence(F.lit(0), F.length(F.bin(F.size(array))) - 1)
        return F.aggregate(
            passes,
            array,
            lambda acc, k: F.transform(
                acc,
                lambda x, i: combine(x, F.get(acc, i - F.call_function("shiftleft", F.lit(1), k))),
            ),
        )

    return let(values, scan)


def prefix_max(values: Column) -> Column:
    """Running maximum of an array; NULL elements are ignored."""
    return prefix_scan(values, lambda x, left: F.greatest(x, left))
