"""Equi-joins of a huge side with a look-up side of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.sizing import fits_broadcast


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    right_row_bytes: int = 64,
    spread_by: str | None = None,
    spread: int = 32,
) -> DataFrame:
    """Join ``left`` with ``right`` on one key that may be very frequent in ``left``.

    ``right`` is broadcast when counting it proves it small. Otherwise both sides are shuffled with the
    key salted: ``left`` by ``spread_by``, ``right`` repeated once per salt, so that a frequent key is
    spread over ``spread`` tasks.
    """
    if fits_broadcast(right, right_row_bytes):
        return left.join(F.broadcast(right), on, how)
    if spread_by is None:
        return left.join(right, on, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(spread)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
