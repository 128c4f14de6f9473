"""Rows packed for jobs that read them many times."""

import numpy as np
from pyspark.ml.linalg import Vectors

from broadsheet.operators import blocks, factors


def test_packed_rows_hold_every_entry(spark, monkeypatch):
    monkeypatch.setattr(blocks, "PACKED_ENTRIES", 8)
    rng = np.random.default_rng(0)
    matrix = rng.standard_normal((30, 6)) * (rng.random((30, 6)) < 0.5)
    df = spark.createDataFrame([(Vectors.sparse(6, {j: x for j, x in enumerate(r) if x}),) for r in matrix.tolist()], ["row"]).coalesce(1)
    packed = blocks.packed_rows(df, 6)
    total = sum(r.size for r in packed.collect())
    assert total == 30 and packed.count() > 5
    block = rng.standard_normal((6, 2))
    assert np.allclose(factors._block_product(packed, 6)(block), matrix.T @ matrix @ block)


def test_full_rows_are_packed_as_a_matrix(spark):
    matrix = np.arange(1.0, 13.0).reshape(4, 3)
    packed = blocks.packed_rows(spark.createDataFrame([(Vectors.dense(r),) for r in matrix.tolist()], ["row"]).coalesce(1), 3)
    assert all(r.row is None for r in packed.collect())
    assert np.allclose(factors._block_product(packed, 3)(np.eye(3)), matrix.T @ matrix)
