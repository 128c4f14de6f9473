"""Term counts, TF-IDF as sparse rows and as a long table, and the reports on it.

A document stays one row until its counts are known: the vocabulary look-up and the counting happen inside the
row, in the JVM, so no document-keyed shuffle is needed. The long table is exploded from those rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Interaction
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.rows import pieces, unnest
from broadsheet.functions.vectors import sparse_entries
from broadsheet.operators.joins import lookup_join
from broadsheet.operators.ranking import top_n
from broadsheet.operators.vocabulary import Vocabulary

PIECE_WORDS = 1 << 18  # counted together in a task


def term_counts(documents: DataFrame) -> DataFrame:
    """``(doc_id, term, f)`` over all words, no vocabulary."""
    words = unnest(documents, ["doc_id"], "words", "term")
    return words.groupBy("doc_id", "term").agg(F.count("*").alias("f"))


def document_length() -> Column:
    """Number of kept words, those outside the vocabulary included."""
    return F.coalesce(F.size("words"), F.lit(0))


def count_rows(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``n`` and the sparse vector ``counts``; ``words`` is dropped. No words (null) count as an empty list."""
    documents = documents.withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    model = CountVectorizerModel.from_vocabulary(vocabulary.terms, inputCol="words", outputCol="counts", minTF=1.0)
    return model.transform(documents).withColumn("n", document_length()).drop("words")


def _weight(counts: Column, length: Column, idf: Column, tf: str) -> Column:
    if tf == "relative":
        return counts / length * idf
    if tf == "raw":
        return counts * idf
    raise ValueError(f"unknown tf {tf!r}, expected 'relative' or 'raw'")


def counts_long(counted: DataFrame, keep_empty: bool = False) -> DataFrame:
    """``(…, n, term_id, f)`` from count rows, one row per row and term in it, whatever the width of the vocabulary.

    ``keep_empty`` leaves rows without terms one row of term 0 with ``f = 0``, so that later groupings do not lose them."""
    others = [c for c in counted.columns if c != "counts"]
    found = sparse_entries("counts", "term_id", "f")
    if keep_empty:
        nothing = F.array(F.struct(F.lit(0).alias("term_id"), F.lit(0.0).alias("f")))
        found = F.when(F.size(found) == 0, nothing).otherwise(found)
    entries = unnest(counted, others, found, "entry")
    return entries.select(*others, "entry.term_id", "entry.f")


def vocabulary_counts(documents: DataFrame, vocabulary: Vocabulary, keep_empty: bool = False) -> DataFrame:
    """The same from documents: rows of one id stay apart, and nothing is shuffled."""
    return counts_long(count_rows(documents, vocabulary), keep_empty)


def tfidf_long(documents: DataFrame, vocabulary: Vocabulary, tf: str = "relative") -> DataFrame:
    """``(…, n, term_id, f, term, w)``: vocabulary counts with their terms and weights."""
    table = vocabulary.table(documents.sparkSession).select("term_id", "term", "idf")
    found = vocabulary_counts(documents, vocabulary).join(F.broadcast(table), "term_id")
    return found.withColumn("w", _weight(F.col("f"), F.col("n"), F.col("idf"), tf)).drop("idf")


def tfidf_long_joined(documents: DataFrame, terms: DataFrame, tf: str = "relative") -> DataFrame:
    """``(doc_id, n, term_id, f, term, w)`` with a vocabulary of any size, a table ``(term_id, term, idf)`` of unique terms.

    The words of a row are counted in the row's own task, so that each term of a row is looked up once and nothing but the
    look-up, salted by row, is shuffled. Rows of one id stay apart.
    """
    entries = counted_in_rows(documents.select("doc_id", "words"))
    found = lookup_join(entries, terms.select("term_id", "term", "idf"), "term", spread_by="at")
    return found.select("doc_id", "n", "term_id", "f", "term", _weight(F.col("f"), F.col("n"), F.col("idf"), tf).alias("w"))


def counted_in_rows(documents: DataFrame) -> DataFrame:
    """``(…, at, n, term, f)``, one row per row of ``(…, words)`` and word in it; ``at`` spreads the rows of a piece.

    A batch is counted in pieces of ``PIECE_WORDS`` words, so that a task's memory does not grow with the batch."""
    others = [f for f in documents.schema.fields if f.name != "words"]
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(len(names))), 0).to_numpy(zero_copy_only=False)
            for start, stop in pieces(sizes, PIECE_WORDS):
                piece, lengths = batch.slice(start, stop - start), sizes[start:stop]
                coded = pc.dictionary_encode(piece.column(len(names)).flatten().cast(pa.string()), null_encoding="encode")
                size = max(1, len(coded.dictionary))
                pairs = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths) * size + coded.indices.to_numpy(zero_copy_only=False)
                pairs, counts = np.unique(pairs, return_counts=True)
                row = pairs // size
                kept = [c.take(pa.array(row)) for c in piece.columns[: len(names)]]
                columns = [*kept, pa.array(row), pa.array(lengths[row].astype(np.int32)), coded.dictionary.take(pa.array(pairs % size)), pa.array(counts.astype(float))]
                found = pa.RecordBatch.from_arrays(columns, names=[*names, "at", "n", "term", "f"])
                yield found.filter(pc.is_valid(found.column(len(names) + 2)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return documents.select(*names, "words").mapInArrow(run, f"{schema}, at bigint, n int, term string, f double")


def tfidf_rows(documents: DataFrame, vocabulary: Vocabulary, tf: str = "relative") -> DataFrame:
    """Adds the sparse vector ``row`` of TF-IDF weights. Documents without kept words get a zero vector."""
    counted = count_rows(documents, vocabulary)
    counts = "counts"
    if tf == "relative":
        share = F.when(F.col("n") > 0, 1.0 / F.col("n")).otherwise(0.0)
        counted = counted.withColumn("share", share)
        counted = Interaction(inputCols=["share", "counts"], outputCol="shares").transform(counted)
        counts = "shares"
    elif tf != "raw":
        raise ValueError(f"unknown tf {tf!r}, expected 'relative' or 'raw'")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(vocabulary.idf), inputCol=counts, outputCol="row")
    return scale.transform(counted).drop("counts", "share", "shares")


def corpus_terms(long: DataFrame) -> DataFrame:
    """``(term_id, term, total)``: column sums, the terms most specific for the corpus first."""
    totals = long.groupBy("term_id", "term").agg(F.sum("w").alias("total"))
    return totals.orderBy(F.desc("total"), F.asc("term_id"))


def document_top_terms(long: DataFrame, n: int = 5) -> DataFrame:
    """``(doc_id, rank, term, w)``: the heaviest terms of each document, terms without weight left out."""
    weighted = long.where("w > 0").select("doc_id", "term_id", "term", "w")
    ranked = top_n(weighted, ["doc_id"], [F.desc("w"), F.asc("term_id")], n)
    return ranked.select("doc_id", "rank", "term", "w")
