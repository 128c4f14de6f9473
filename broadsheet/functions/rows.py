"""Arrays to rows, and functions that must run once per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: list[str | Column], array: str | Column, value: str, at: str | None = None) -> DataFrame:
    """One row per non-null array entry, with its position in ``at`` if asked for.

    The outer form of explode is deliberate: for the plain form Spark adds a filter on the array's size and
    pushes it down, where it evaluates whatever made the array, tokenising or Python included, a second time.
    """
    entry = F.posexplode_outer(array).alias(at, value) if at else F.explode_outer(array).alias(value)
    return df.select(*keep, entry).where(F.col(value).isNotNull())


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes, and one more for each row, add up to ``most`` at the utmost; a larger row is a range
    of its own."""
    ends = np.cumsum(np.asarray(sizes, np.int64) + 1)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def run_once(udf: Callable[..., Column]) -> Callable[..., Column]:
    """Keep Spark from copying a Python function into filters on its result, which would run it twice."""
    return udf.asNondeterministic()
