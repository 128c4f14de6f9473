"""Lemmas by a join: what goes into it."""

from broadsheet.operators import lemmas


def test_a_word_is_looked_up_once_for_a_block(spark):
    rows = [(1, ["cats", "sat"] * 50), (1, None), (None, []), (2, ["cats", "on"])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, words ARRAY<STRING>").coalesce(1)
    blocks = docs.selectExpr("doc_id", "words", "CAST(7 AS BIGINT) AS _block")
    assert sorted(tuple(r) for r in lemmas._distinct_words(blocks).collect()) == [(7, "cats"), (7, "on"), (7, "sat")]
    forms = spark.createDataFrame([("cats", "cat"), ("sat", None)], "form STRING, lemma STRING")
    got = [(r.doc_id, r.words) for r in lemmas.lemmatise(docs, forms, most=0).collect()]
    assert sorted(got, key=str) == sorted([(1, ["cat", "sat"] * 50), (1, []), (None, []), (2, ["cat", "on"])], key=str)
