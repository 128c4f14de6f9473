"""Words to lemmas: dictionary look-up with identity fallback, or a lemmatiser of the user's own."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.rows import pieces, run_once
from broadsheet.functions.sizing import fits_broadcast
from broadsheet.functions.tokens import keep_words, tokens
from broadsheet.operators.joins import lookup_join
from broadsheet.session import numbered

MAX_DICTIONARY = 1_000_000
PIECE_CHARS = 1 << 20  # of the texts that a user's lemmatiser has turned into words at a time
BLOCK_ROWS = 256  # looked up together where a dictionary is joined


def document_words(
    documents: DataFrame,
    stop_words: Iterable[str] = (),
    min_length: int = 3,
    dictionary: DataFrame | None = None,
    make_lemmatiser: Callable[[], Callable[[str], list[str]]] | None = None,
) -> DataFrame:
    """Adds ``words``: the words of ``text`` that may enter a vocabulary, as lemmas if a dictionary or a lemmatiser of the
    user's own is given. ``text`` is dropped, other columns stay."""
    if make_lemmatiser is not None:
        if dictionary is not None:
            raise ValueError("give a dictionary or a lemmatiser, not both")
        return lemmatise_with(documents, make_lemmatiser, stop_words)
    tokenised = documents.withColumn("words", tokens("text")).drop("text")
    if dictionary is not None:
        tokenised = lemmatise(tokenised, dictionary)
    return tokenised.withColumn("words", keep_words("words", stop_words, min_length))


def remove_stop_words(words: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Long form: rows of ``(…, word)`` whose word is not in a ``word`` table of any size."""
    return words.join(stop_words.select("word"), "word", "left_anti")


def lemmatise(documents: DataFrame, dictionary: DataFrame, most: int = MAX_DICTIONARY) -> DataFrame:
    """Replaces each entry of ``words`` by its lemma from a ``(form, lemma)`` table.

    A dictionary of up to ``most`` forms, whose texts fit a broadcast, goes to the tasks and is looked up batch-wise there, so
    documents are not shuffled. A larger one is joined, and the words are put together again row by row. Either way a form that is
    listed several times takes its smallest lemma, null entries are dropped, a null list becomes empty, and rows of equal or
    null ids stay apart.
    """
    documents = documents.withColumn("words", F.array_compact("words"))
    unique = dictionary.where("form IS NOT NULL").groupBy("form").agg(F.min("lemma").alias("lemma"))
    if not fits_broadcast(unique, 32, most_rows=most):
        return _lemmatise_by_join(documents, unique)
    found = unique.toArrow().combine_chunks()
    table = documents.sparkSession.sparkContext.broadcast([_one_array(found.column(c)) for c in ("form", "lemma")])

    @F.arrow_udf("array<string>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forms, lemmas = table.value
        for words in batches:
            yield _replaced(words, forms, lemmas)

    return documents.withColumn("words", run_once(look_up)("words"))


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([c.cast(pa.string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.string())


def _replaced(words: pa.Array, forms: pa.Array, lemmas: pa.Array) -> pa.ListArray:
    """Lists of words with the lemma in place of each form that has one; null lists are empty."""
    flat = words.flatten().cast(pa.string())
    found = lemmas.take(pc.index_in(flat, value_set=forms))
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(words), 0)).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, pc.coalesce(found, flat))


def _lemmatise_by_join(documents: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same for a dictionary of any size. The distinct words of a block of rows are joined, each once, and what is found
    meets its block again; words without an entry in the dictionary go no further than the join."""
    columns, text = documents.columns, T.ArrayType(T.StringType())
    schema = T.StructType([T.StructField(f.name, text if f.name == "words" else f.dataType) for f in documents.schema])
    blocks = numbered(documents, "_block").withColumn("_block", F.floor(F.col("_block") / BLOCK_ROWS))
    listed = dictionary.where("lemma IS NOT NULL")
    found = lookup_join(_distinct_words(blocks), listed, "form", spread_by="_block").select("_block", "form", "lemma")

    def replace(rows: pa.Table, entries: pa.Table) -> pa.Table:
        words = _replaced(rows.column("words").combine_chunks(), *(_one_array(entries.column(c)) for c in ("form", "lemma")))
        return rows.set_column(rows.column_names.index("words"), "words", words).select(columns)

    return blocks.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(replace, schema)


def _distinct_words(blocks: DataFrame) -> DataFrame:
    """``(_block, form)``: the words of each block; a word is repeated only where a batch ends inside its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            borders = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(numbers) else []
            for start, stop in zip(borders[:-1], borders[1:], strict=True):
                forms = batch.column(1).slice(start, stop - start).flatten().cast(pa.string()).unique()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(forms), numbers[start])), forms], names=["_block", "form"])

    return blocks.select("_block", "words").mapInArrow(run, "_block bigint, form string")


def lemmatise_with(
    documents: DataFrame, make_lemmatiser: Callable[[], Callable[[str], list[str]]], stop_words: Iterable[str] = ()
) -> DataFrame:
    """Runs a user's lemmatiser over ``text``; its costly set-up happens once per task, not per document. Of its lemmas those of
    three letters and more stay; null text is empty. The words of few texts are held at a time."""
    stop = frozenset(stop_words)
    others = [f for f in documents.schema.fields if f.name not in ("text", "words")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["words array<string>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to_lemmas = make_lemmatiser()
        for batch in batches:
            for start, stop_ in pieces([len(text or "") for text in batch["text"]], PIECE_CHARS):
                part = batch.iloc[start:stop_]
                words = [[w for w in to_lemmas(text or "") if len(w) >= 3 and w.isalpha() and w not in stop] for text in part["text"]]
                yield part[[f.name for f in others]].assign(words=words)

    return documents.mapInPandas(run, schema)
