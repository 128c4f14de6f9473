"""Bounded samples of labelled documents for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_: Column, of: int) -> Column:
    """The part that a document belongs to: crc32 of its id as text, modulo ``of``."""
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(of))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, usable: Column) -> DataFrame:
    """``(doc_id, text, y)`` for at most ``most`` labelled documents, those of the smallest hashes.

    ``usable`` is a condition on the labels' ``doc_id``. The sampled ids, ``most`` at the utmost, are broadcast. Null labels
    and ids do not count; a document labelled twice takes the larger label, and an id with several texts the smallest of them.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(usable)
    ids = known.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    picked = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
