"""Publication counts over time.

A running count over all rows is a prefix sum. Rows are put into one global order by a range shuffle, which
splits even a single frequent date, since the id is part of the order. Each task then needs only the counts of
the tasks before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.sizing import fits_broadcast
from broadsheet.session import durable

PART_ROWS = 4_000_000  # rows of one task, at which further ones are taken
OFFSET_BYTES = 256  # at which the row of a task and class is reckoned when they are to be broadcast


def corpus_span(df: DataFrame, date: str = "date") -> DataFrame:
    """``(n, first_date, last_date)``."""
    return df.agg(F.count("*").alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def keep_classes(df: DataFrame, classes: Iterable) -> DataFrame:
    return df.where(F.col("class").isin(list(classes)))


def label_classes(df: DataFrame, labels: DataFrame, class_type: str = "string") -> DataFrame:
    """Replaces ``class`` by its label from a ``(class, label)`` table; classes without label stay."""
    joined = df.join(labels, "class", "left")
    label: Column = F.coalesce(F.col("label"), F.col("class").cast(class_type))
    return joined.withColumn("class", label).drop("label")


def class_timeline(df: DataFrame, id_column: str = "doc_id", parts: int | None = None) -> DataFrame:
    """``(id, date, class, csum, total, share)``: running count within the class, over all classes, and their
    ratio, in order of date, class, id.

    The rows are shuffled once, into their order. While they stream out of it each task numbers them, over all and per class;
    these rows are frozen on shared storage, and the last numbers of the tasks before are added. ``parts`` is the number of
    tasks; by default the session's shuffle partitions, or as many as leave each ``PART_ROWS`` rows.
    """
    spark = df.sparkSession
    order = [F.asc_nulls_last("date"), F.asc("class"), F.asc(id_column)]
    if parts is None:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PART_ROWS))
    ordered = df.select(id_column, "date", "class").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = durable(_numbered_in_tasks(ordered))

    # One row per task and class, and one per task, whatever the number of documents.
    classes = numbered.groupBy("_part", "class").agg(F.max("_in_class").alias("rows"))
    earlier = Window.partitionBy("class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = classes.select(F.col("_part").alias("_of"), F.col("class").alias("_class"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_class_before"))
    before, total = [], 0
    for part, rows in sorted(numbered.groupBy("_part").agg(F.max("_in_all")).collect()):  # one row per task
        before.append((part, total))
        total += rows
    starts = spark.createDataFrame(before, "_part INT, _before BIGINT")

    offsets = durable(offsets)
    if fits_broadcast(offsets, OFFSET_BYTES):
        offsets = F.broadcast(offsets)
    same_place = (F.col("_part") == F.col("_of")) & F.col("class").eqNullSafe(F.col("_class"))
    placed = numbered.join(F.broadcast(starts), "_part").join(offsets, same_place)
    csum, total_ = F.col("_class_before") + F.col("_in_class"), F.col("_before") + F.col("_in_all")
    return placed.select(id_column, "date", "class", csum.alias("csum"), total_.alias("total"), (csum / total_).alias("share"))


def _numbered_in_tasks(ordered: DataFrame) -> DataFrame:
    """Adds to each row its number within its task, ``_in_all``, and among the task's rows of its class, ``_in_class``, counted
    as the rows stream by, and the number of the task, ``_part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, last = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            n = batch.num_rows
            coded = pc.dictionary_encode(batch.column(2), null_encoding="encode")
            codes = coded.indices.to_numpy(zero_copy_only=False)
            by_class = np.argsort(codes, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(codes[by_class]) != 0])
            sizes = np.diff(np.r_[first, n])
            number = np.empty(n, np.int64)
            number[by_class] = np.arange(n) - np.repeat(first, sizes) + 1
            names = coded.dictionary.to_pylist()
            number += np.array([last.get(c, 0) for c in names], np.int64)[codes]
            for code, size in zip(codes[by_class[first]].tolist(), sizes.tolist(), strict=True):
                last[names[code]] = last.get(names[code], 0) + size
            added = [pa.array(number), pa.array(np.arange(rows + 1, rows + n + 1)), pa.array(np.full(n, part, np.int32))]
            rows += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_in_class", "_in_all", "_part"])

    kinds = [T.StructField("_in_class", T.LongType()), T.StructField("_in_all", T.LongType()), T.StructField("_part", T.IntegerType())]
    return ordered.mapInArrow(run, T.StructType([*ordered.schema.fields, *kinds]))
