import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from broadsheet.functions import tokens as tok
from broadsheet.operators import joins, lemmas, ranking, tfidf, vocabulary
from broadsheet.operators.lemmas import document_words


def weights(long):
    return {(r.doc_id, r.term): r.w for r in long.collect()}


def test_vocabulary_order_and_idf(spark, mini):
    found = vocabulary.build_vocabulary(mini, 10)
    assert found.terms == ["banana", "apple", "cherry"]
    assert found.df == [3, 1, 1] and found.n_docs == 3
    assert found.idf == pytest.approx([0.0, math.log(3), math.log(3)])
    top = vocabulary.most_frequent(vocabulary.document_frequencies(mini), 2)
    lazy = vocabulary.with_idf(top, mini).orderBy("term_id").collect()
    assert [(r.term_id, r.term, r.df) for r in lazy] == [(0, "banana", 3), (1, "apple", 1)]
    assert lazy[1].idf == pytest.approx(math.log(3))
    with pytest.raises(ValueError):
        vocabulary.build_vocabulary(mini, 0)


def test_terms_may_be_tested_instead_of_tokens(spark):
    docs = spark.createDataFrame([(1, "The cat, the 2 cats"), (2, "A cat_1 the cat"), (3, "")], "doc_id BIGINT, text STRING")
    tokenised = docs.select("doc_id", tok.tokens("text").alias("words"))
    after = vocabulary.build_vocabulary(tokenised, 10, tok.usable(F.col("term"), ["the"]))
    assert after == vocabulary.build_vocabulary(document_words(docs, ["the"]), 10)
    assert after.terms == ["cat", "cats"] and after.n_docs == 3


def test_hand_worked_weights(spark, mini):
    found = vocabulary.build_vocabulary(mini, 10)
    got = weights(tfidf.tfidf_long(mini, found))
    assert got == pytest.approx(
        {(1, "apple"): 0.732408, (1, "banana"): 0.0, (2, "banana"): 0.0, (2, "cherry"): 0.549306, (3, "banana"): 0.0},
        abs=1e-6,
    )
    raw = weights(tfidf.tfidf_long(mini, found, tf="raw"))
    assert raw[(1, "apple")] == pytest.approx(2 * math.log(3))
    with pytest.raises(ValueError):
        tfidf.tfidf_long(mini, found, tf="log")


def test_length_counts_words_outside_the_vocabulary(spark, mini):
    found = vocabulary.build_vocabulary(mini, 2)
    assert weights(tfidf.tfidf_long(mini, found))[(1, "apple")] == pytest.approx(2 / 3 * math.log(3))


@pytest.mark.parametrize("width", [3, 20_000])
def test_rows_of_one_id_stay_apart_at_every_width(spark, width):
    docs = spark.createDataFrame([(1, ["a", "b"]), (1, ["a", "c", "a"]), (2, None), (3, [])], "doc_id BIGINT, words ARRAY<STRING>")
    found = vocabulary.Vocabulary(["a", "b", "c"] + [f"x{i}" for i in range(width - 3)], [2] + [1] * (width - 1), 4)
    long = tfidf.tfidf_long(docs, found)
    assert sorted((r.doc_id, r.term, r.f, r.n) for r in long.collect()) == [(1, "a", 1, 2), (1, "a", 2, 3), (1, "b", 1, 2), (1, "c", 1, 3)]
    kept = tfidf.vocabulary_counts(docs, found, keep_empty=True)
    assert sorted((r.doc_id, r.term_id, r.f) for r in kept.where("f = 0").collect()) == [(2, 0, 0.0), (3, 0, 0.0)]
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_sparse_products_equal_dense_ones(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from broadsheet.functions import vectors as vec

    monkeypatch.setattr(vec, "BLOCK_VALUES", 4)
    rng = np.random.default_rng(0)
    dense = rng.integers(0, 3, (40, 6)) * rng.random((40, 6))
    dense[3] = 0
    loadings = rng.random((6, 2))
    rows = [(i, Vectors.sparse(6, [(j, x) for j, x in enumerate(r) if x]) if i % 2 else Vectors.dense(r)) for i, r in enumerate(dense)]
    df = spark.createDataFrame(rows, ["doc_id", "row"])
    got = {r.doc_id: list(r.x) for r in df.select("doc_id", vec.project_sparse("row", loadings).alias("x")).collect()}
    assert all(got[i] == pytest.approx((dense @ loadings)[i]) for i in range(40))
    entries = df.select("doc_id", vec.sparse_entries("row", "at", "x").alias("e")).collect()
    assert all([(e["at"], e.x) for e in r.e] == [(j, x) for j, x in enumerate(dense[r.doc_id]) if x] for r in entries)


def test_rows_equal_the_long_table_and_keep_empty_documents(spark, mini_with_empty):
    found = vocabulary.build_vocabulary(mini_with_empty, 10)
    rows = {r.doc_id: list(r.x) for r in tfidf.tfidf_rows(mini_with_empty, found).select("doc_id", vector_to_array("row").alias("x")).collect()}
    assert rows[4] == [0.0, 0.0, 0.0]
    ids = {t: i for i, t in enumerate(found.terms)}
    for (doc, term), w in weights(tfidf.tfidf_long(mini_with_empty, found)).items():
        assert rows[doc][ids[term]] == pytest.approx(w, abs=1e-12)


def test_reports(spark, mini):
    found = vocabulary.build_vocabulary(mini, 10)
    long = tfidf.tfidf_long(mini, found)
    assert [r.term for r in tfidf.corpus_terms(long).collect()] == ["apple", "cherry", "banana"]
    top = tfidf.document_top_terms(long, 5).collect()
    assert sorted((r.doc_id, r["rank"], r.term) for r in top) == [(1, 1, "apple"), (2, 1, "cherry")]
    counts = {(r.doc_id, r.term): r.f for r in tfidf.term_counts(mini).collect()}
    assert counts[(1, "apple")] == 2 and len(counts) == 5


def test_ranking_is_the_same_when_spread(spark):
    df = spark.range(5000).select(F.col("id"), F.pmod(F.col("id"), F.lit(3)).alias("g"), F.pmod(F.hash("id"), F.lit(50)).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    plain = sorted(map(tuple, ranking.top_n(df, ["g"], order, 7).collect()))
    spread = sorted(map(tuple, ranking.top_n(df, ["g"], order, 7, spread_by="id", spread=5).collect()))
    assert plain == spread and len(plain) == 21


def test_lookup_join_is_the_same_when_salted(spark, monkeypatch):
    left = spark.range(1000).select("id", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 20).cast("int").alias("k"))
    right = spark.createDataFrame([(i, str(i)) for i in range(15)], "k INT, name STRING")
    for how in ("inner", "left"):
        small = sorted(map(str, joins.lookup_join(left, right, "k", how, spread_by="id").collect()))
        with monkeypatch.context() as patch:
            patch.setattr(joins, "fits_broadcast", lambda *_: False)
            salted = sorted(map(str, joins.lookup_join(left, right, "k", how, spread_by="id").collect()))
        assert small == salted


def test_stop_word_removal(spark):
    words = spark.createDataFrame([(1, "the"), (1, "cat"), (2, "of")], "doc_id INT, word STRING")
    stop = spark.createDataFrame([("the",), ("of",)], "word STRING")
    assert [tuple(r) for r in lemmas.remove_stop_words(words, stop).select("doc_id", "word").collect()] == [(1, "cat")]


@pytest.fixture
def forms(spark):
    docs = spark.createDataFrame([(1, ["cats", "sat", "cats"]), (2, []), (3, ["sat"]), (4, None)], "doc_id BIGINT, words ARRAY<STRING>")
    return docs, spark.createDataFrame([("cats", "cat"), ("sat", "sit")], "form STRING, lemma STRING")


def test_lemmas_by_look_up_and_by_join_agree(spark, forms):
    expected = {1: ["cat", "sit", "cat"], 2: [], 3: ["sit"], 4: []}
    looked_up = {r.doc_id: r.words for r in lemmas.lemmatise(*forms).collect()}
    joined = {r.doc_id: r.words for r in lemmas.lemmatise(*forms, most=1).collect()}
    assert looked_up == expected and joined == expected


def test_unknown_forms_stay(spark, forms):
    docs = spark.createDataFrame([(1, "Dogs, cats 7")], "doc_id BIGINT, text STRING")
    assert document_words(docs, dictionary=forms[1]).first().words == ["dogs", "cat"]


def test_own_lemmatiser_is_set_up_once_per_task(spark):
    docs = spark.createDataFrame([(i, "Run" + "n" * i + " the of 42") for i in range(20)] + [(20, None)], "doc_id BIGINT, text STRING").coalesce(1)

    def make():
        seen = []

        def split(text):
            seen.append(text)
            return [w.lower() for w in text.split()] + ["call" + "l" * len(seen)]

        return split

    got = {r.doc_id: r.words for r in lemmas.lemmatise_with(docs, make, ["the"]).collect()}
    assert got[0] == ["run", "calll"] and got[19] == ["run" + "n" * 19, "call" + "l" * 20]
    assert got[20] == ["call" + "l" * 21]


@pytest.mark.parametrize("most", [lemmas.MAX_DICTIONARY, 0])
def test_both_forms_of_the_dictionary_keep_rows_apart(spark, most):
    docs = spark.createDataFrame([(1, ["cats"]), (1, ["sat", None, "cats"]), (None, ["sat"]), (2, []), (3, None)], "doc_id bigint, words array<string>")
    table = spark.createDataFrame([("cats", "kitten"), ("cats", "cat"), (None, "x"), ("sat", None)], "form string, lemma string")
    found = lemmas.lemmatise(docs, table, most)
    assert found.columns == docs.columns
    assert sorted(str((r.doc_id, r.words)) for r in found.collect()) == sorted(
        map(str, [(1, ["cat"]), (1, ["sat", "cat"]), (None, ["sat"]), (2, []), (3, [])])
    )
