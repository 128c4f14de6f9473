"""Projections of sparse rows on many axes, some rows at a time."""

import numpy as np
from pyspark.ml.linalg import Vectors

from broadsheet.functions import vectors
from broadsheet.operators import factors


def test_rows_are_projected_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VALUES", 16)
    loadings = np.arange(12.0).reshape(4, 3)
    rows = [(i, Vectors.sparse(4, {i % 4: 1.0 + i}) if i % 5 else Vectors.sparse(4, {})) for i in range(30)]
    df = spark.createDataFrame(rows, ["doc_id", "row"]).coalesce(1)
    got = {r.doc_id: r.projection for r in factors.project_rows(df, loadings).collect()}
    for i, v in rows:
        assert np.allclose(got[i], v.toArray() @ loadings)
    out = np.zeros((2, 3))
    vectors.add_entries(out, np.array([0, 0, 1]), np.array([1, 2, 3]), np.array([1.0, 2.0, 3.0]), loadings)
    assert np.allclose(out, [loadings[1] + 2 * loadings[2], 3 * loadings[3]])
