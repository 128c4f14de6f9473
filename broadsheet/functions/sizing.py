"""Guards for everything that leaves the distributed world: driver rows and broadcast sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 256 * 1024 * 1024
FEW_SPLITS = 32


def driver_rows(df: DataFrame, most: int, what: str) -> list[Row]:
    """Collect a table that must be small; refuse instead of truncating when it is not."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows, too many for the driver")
    return rows


def text_bytes(df: DataFrame) -> Column:
    """What the texts of a row take, arrays of texts included."""
    sizes = [F.lit(0).cast("bigint")]
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint"))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            sizes.append(F.aggregate(F.coalesce(f.name, F.array().cast("array<string>")), F.lit(0).cast("bigint"), lambda n, x: n + 16 + F.coalesce(F.octet_length(x), F.lit(0))))
    return sum(sizes[1:], sizes[0])


def fits_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, most_rows: int | None = None) -> bool:
    """True when a pass over ``df`` proves that it stays below ``limit`` bytes: ``row_bytes`` for each row, and the length of
    all its texts; and below ``most_rows`` rows, if given."""
    found = df.agg(F.count("*").alias("n"), F.sum(text_bytes(df)).alias("texts")).first()
    return found.n * row_bytes + (found.texts or 0) <= limit and (most_rows is None or found.n <= most_rows)


def spread_out(scan: DataFrame) -> DataFrame:
    """Give a scan of fewer splits than cores one split per core, such as a file of a single row group.

    Only for bare scans: the number of splits is then known from planning, without a job. From ``FEW_SPLITS`` splits on a
    table is left alone on any cluster, so that no large one is ever shuffled for this.
    """
    cores = min(scan.sparkSession.sparkContext.defaultParallelism, FEW_SPLITS)
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
