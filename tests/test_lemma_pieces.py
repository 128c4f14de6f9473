"""A user's lemmatiser gets the texts of a batch piece by piece."""

from broadsheet.operators import lemmas


def test_a_piece_leaves_before_the_next_one(spark, monkeypatch):
    monkeypatch.setattr(lemmas, "PIECE_CHARS", 12)
    docs = spark.createDataFrame([(i, "some words" if i % 3 else None) for i in range(9)], "doc_id BIGINT, text STRING").coalesce(1)
    got = {r.doc_id: r.words for r in lemmas.lemmatise_with(docs, lambda: str.split, ["some"]).collect()}
    assert got == {i: ["words"] if i % 3 else [] for i in range(9)}
