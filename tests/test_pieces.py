"""Batches worked on in pieces."""

from broadsheet.functions.rows import pieces
from broadsheet.operators import tfidf


def test_pieces_hold_all_rows_once():
    assert list(pieces([3, 0, 5, 100], 10)) == [(0, 2), (2, 3), (3, 4)]
    assert list(pieces([], 10)) == []


def test_words_are_counted_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "PIECE_WORDS", 4)
    rows = [(i, f"s{i}", ["a", "b", "a"] if i % 2 else None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, words ARRAY<STRING>").coalesce(1)
    found = tfidf.counted_in_rows(docs).collect()
    assert sorted((r.doc_id, r.source, r.n, r.term, r.f) for r in found) == [x for i in range(1, 20, 2) for x in ((i, f"s{i}", 3, "a", 2.0), (i, f"s{i}", 3, "b", 1.0))]
    assert max(r.at for r in found) < 4
