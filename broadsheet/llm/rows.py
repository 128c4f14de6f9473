"""Arrow batches in tasks: texts as bytes, added columns, and joins that no hot key can overload."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.session import durable

SLICE_ROWS = 512
HEAVY_KEYS = 1024


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts an object of bounded size with the classes it is made of, so that workers need not have this package; the
    function returned gives it in a task, where it is read once."""
    box = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    opened: list = []

    def get() -> Any:
        if not opened:
            opened.append(pickle.loads(box.value))
        return opened[0]

    return get


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of few rows, so that what Python makes of the texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts in UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fresh_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has the name (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_struct(
    df: DataFrame, text: str, fields: str, make: Callable[[list[bytes]], list[list]], name: str = "found"
) -> tuple[DataFrame, str]:
    """All columns of ``df`` and one struct column with what ``make`` finds in the texts of a slice.

    ``fields`` is the DDL of the struct and ``make`` returns one list per field. No shuffle; the name of the new column,
    which clashes with none, is returned as well.
    """
    added = fresh_name(df.columns, name)
    kind = T._parse_datatype_string(fields)
    schema = T.StructType([*df.schema.fields, T.StructField(added, kind)])
    from pyspark.sql.pandas.types import to_arrow_type

    struct = to_arrow_type(kind)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            values = make(as_bytes(piece.column(at)))
            arrays = [pa.array(v, f.type) for v, f in zip(values, struct, strict=True)]
            column = pa.StructArray.from_arrays(arrays, fields=list(struct))
            yield pa.RecordBatch.from_arrays([*piece.columns, column], names=[*piece.schema.names, added])

    return df.mapInArrow(run, schema), added


def join_on_counted(left: DataFrame, right: DataFrame, keys: list[str], counts: str, how: str = "inner") -> DataFrame:
    """Joins ``left`` with ``right``, unique on ``keys``, whose column ``counts`` says how many rows of ``left`` have the key.

    Fewer than ``HEAVY_KEYS`` keys can each hold more than that fraction of the rows; these few rows of ``right`` are
    broadcast, and every other key goes through a shuffle join in which none holds more than a thousandth. ``how`` is
    ``inner`` or ``left``. Null keys match nothing.
    """
    right = durable(right)
    total = right.agg(F.sum(counts)).first()[0] or 0
    heavy_if = F.col(counts) > total / HEAVY_KEYS
    heavy = right.where(heavy_if)
    tag = fresh_name([*left.columns, *right.columns], "heavy")
    tagged = left.join(F.broadcast(heavy.select(*keys).withColumn(tag, F.lit(True))), keys, "left")
    hot = tagged.where(F.col(tag)).drop(tag).join(F.broadcast(heavy), keys, "inner")
    rest = tagged.where(F.col(tag).isNull()).drop(tag).join(right.where(~heavy_if), keys, how)
    return hot.unionByName(rest)
