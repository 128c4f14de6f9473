"""Document frequencies and the bounded vocabulary."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.functions.rows import unnest
from broadsheet.functions.sizing import driver_rows
from broadsheet.session import durable

MAX_TERMS = 100_000


def document_frequencies(documents: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents each word occurs. Repeats within a document go before the
    shuffle, and counts are combined in each task, so a word of every document is no hot key."""
    terms = unnest(documents, [], F.array_distinct("words"), "term")
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def most_frequent(frequencies: DataFrame, num_terms: int) -> DataFrame:
    """``(term_id, term, df)`` of the ``num_terms`` most frequent terms; ties go to the smaller word."""
    kept = frequencies.orderBy(F.desc("df"), F.asc("term")).limit(num_terms)
    # At most num_terms rows reach this single-task window.
    numbered = F.row_number().over(Window.orderBy(F.desc("df"), F.asc("term"))) - 1
    return kept.select(numbered.alias("term_id"), "term", "df")


def number_terms(frequencies: DataFrame, num_terms: int | None = None, parts: int | None = None) -> DataFrame:
    """``(term_id, term, df)`` of the ``num_terms`` most frequent terms, or of all, as a table of any size: the numbers are those
    of ``most_frequent``.

    The terms are put into their order by a range shuffle and numbered task by task; only the sizes of the tasks come to
    the driver. The ordered terms are frozen on shared storage, so that both steps see the same tasks.
    """
    spark = frequencies.sparkSession
    order = [F.desc("df"), F.asc("term")]
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ordered = frequencies.select("term", "df").repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at)
    frozen = durable(ordered.select("term", "df", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")))
    starts, total = [], 0
    for part, rows in sorted(frozen.groupBy("_part").agg(F.count("*")).collect()):  # one row per task
        starts.append((part, total))
        total += rows
    table = F.broadcast(spark.createDataFrame(starts, "_part BIGINT, _start BIGINT"))
    found = frozen.join(table, "_part").select((F.col("_start") + F.col("_row")).alias("term_id"), "term", "df")
    return found if num_terms is None else found.where(F.col("term_id") < num_terms)


def with_idf(vocabulary: DataFrame, documents: DataFrame) -> DataFrame:
    """Adds ``idf``, the natural logarithm of documents per document with the term, unsmoothed."""
    n_docs = documents.agg(F.count("*").alias("n")).scalar()
    return vocabulary.withColumn("idf", F.log(n_docs.cast("double") / F.col("df")))


@dataclass(frozen=True)
class Vocabulary:
    """The bounded vocabulary on the driver; ``table`` gives it back to a plan."""

    terms: list[str]
    df: list[int]
    n_docs: int

    @property
    def idf(self) -> list[float]:
        return [math.log(self.n_docs / df) for df in self.df]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(term_id, term, df, idf)`` as a local relation: its size is known to the join planner."""
        rows = [(i, *row) for i, row in enumerate(zip(self.terms, self.df, self.idf))]
        return spark.createDataFrame(rows, "term_id INT, term STRING, df BIGINT, idf DOUBLE")


def build_vocabulary(documents: DataFrame, num_terms: int = 1000, usable: Column | None = None) -> Vocabulary:
    """One pass for the frequencies, one row count; ``num_terms`` rows come to the driver.

    With ``usable``, a condition on ``term``, ``words`` may hold all tokens: Spark then tests the distinct words of
    a document in generated code, which is cheaper than testing every token of the array.
    """
    if not 0 < num_terms <= MAX_TERMS:
        raise ValueError(f"num_terms must be between 1 and {MAX_TERMS}")
    frequencies = document_frequencies(documents)
    if usable is not None:
        frequencies = frequencies.where(usable)
    kept = frequencies.orderBy(F.desc("df"), F.asc("term")).limit(num_terms)
    rows = driver_rows(kept, num_terms, "vocabulary")
    return Vocabulary([r.term for r in rows], [r.df for r in rows], documents.count())
