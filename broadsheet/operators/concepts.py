"""Latent concepts: their strongest terms and documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.vectors import vector_matrix
from broadsheet.operators.factors import Decomposition, project_rows
from broadsheet.operators.ranking import top_n

EQUAL_DIGITS = 10  # decimals in which weights agree that differ by the order of sums only


def concept_terms(found: Decomposition, vocabulary: DataFrame, concepts: int = 10, n: int = 10) -> DataFrame:
    """``(concept, rank, term, weight)`` by signed weight in the right vectors, equal ones by term number."""
    weights = found.right_table(vocabulary.sparkSession).where(F.col("concept") < concepts)
    ranked = top_n(weights, ["concept"], [F.desc(F.round("weight", EQUAL_DIGITS)), F.asc("term_id")], n)
    return ranked.join(vocabulary.select("term_id", "term"), "term_id").select("concept", "rank", "term", "weight")


def left_vectors(rows: DataFrame, found: Decomposition, concepts: int) -> DataFrame:
    """``(doc_id, projection)`` with the left singular vectors: rows times right vectors over the values."""
    kept = min(concepts, len(found.values))
    scaled = found.right[:, :kept] / found.values[np.newaxis, :kept]
    return project_rows(rows, scaled)


def concept_documents(rows: DataFrame, found: Decomposition, concepts: int = 10, n: int = 10) -> DataFrame:
    """``(concept, rank, doc_id, weight)`` by signed weight in the left vectors, equal ones by id.

    Each task keeps the ``n`` best documents of each concept while its batches stream by, and only these are ranked.
    """
    kept = min(concepts, len(found.values))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in range(kept)]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            weights = vector_matrix(batch.column(1), kept)
            for c, (old_ids, old) in enumerate(best):
                all_ids, every = np.concatenate([old_ids, ids]), np.concatenate([old, weights[:, c]])
                first = np.lexsort((all_ids, -every.round(EQUAL_DIGITS)))[:n]
                best[c] = (all_ids[first], every[first])
        sizes = [len(ids) for ids, _ in best]
        columns = [pa.array(np.repeat(np.arange(kept), sizes), pa.int32()), pa.array(np.concatenate([i for i, _ in best]), pa.int64()), pa.array(np.concatenate([w for _, w in best]))]
        yield pa.RecordBatch.from_arrays(columns, names=["concept", "doc_id", "weight"])

    projected = left_vectors(rows.where("doc_id IS NOT NULL"), found, concepts).select(F.col("doc_id").cast("bigint"), "projection")
    entries = projected.mapInArrow(candidates, "concept int, doc_id bigint, weight double")
    order = [F.desc(F.round("weight", EQUAL_DIGITS)), F.asc("doc_id")]
    return top_n(entries, ["concept"], order, n, spread_by="doc_id").select("concept", "rank", "doc_id", "weight")


def describe_concepts(terms: DataFrame, documents: DataFrame) -> DataFrame:
    """``(concept, terms, doc_ids)``, both lists in rank order."""
    words = F.array_sort(F.collect_list(F.struct("rank", "term")))["term"]
    ids = F.array_sort(F.collect_list(F.struct("rank", "doc_id")))["doc_id"]
    left = terms.groupBy("concept").agg(words.alias("terms"))
    right = documents.groupBy("concept").agg(ids.alias("doc_ids"))
    return left.join(right, "concept")
