"""Singular values, principal components and projections.

Matrices here are tall and narrow: documents by a bounded number of terms or dimensions. One pass adds up the
small square matrix of column products; its decomposition is a driver matter of that bounded size. Wider matrices
are decomposed in a subspace that grows by a block of vectors with each pass over the sparse rows; the driver holds some blocks
of as many rows as there are columns. A last pass factors the projected rows by QR in a tree over the tasks, so that small
singular values are as exact as large ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.sizing import BROADCAST_BYTES
from broadsheet.functions.vectors import add_entries, project, project_sparse
from broadsheet.operators.blocks import SCHEMA, added_up, block_batches, packed_rows, unpacked

MAX_COLUMNS = 4096
OVERSAMPLE = 10  # vectors of a block beyond those asked for
MAX_PASSES = 300
SETTLED = 1e-12  # residual, as a part of the largest eigenvalue, at which a vector is done
CHUNK_COLUMNS = 1024
TREE_TASKS = 32


def row_matrix(df: DataFrame, vector: str = "row") -> RowMatrix:
    """Distributed matrix of a vector column; stays in the JVM."""
    return RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(vector), vector))


def gram_matrix(df: DataFrame, width: int, vector: str = "row") -> np.ndarray:
    """Sum of the outer products of all rows, added up in a tree over the tasks."""
    if width > MAX_COLUMNS:
        raise ValueError(f"{width} columns, more than {MAX_COLUMNS}: the square matrix would not stay small")
    return row_matrix(df, vector).computeGramianMatrix().toArray()


def gram_table(spark: SparkSession, gram: np.ndarray) -> DataFrame:
    """``(i, j, value)`` of the square matrix, which leaves the driver as one array per row."""
    size = len(gram)
    starts = np.arange(size + 1, dtype=np.int32) * size
    values = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(gram, np.float64).ravel()))
    rows = spark.createDataFrame(pa.table({"i": np.arange(size, dtype=np.int32), "row": values}), "i INT, row ARRAY<DOUBLE>")
    return rows.select("i", F.posexplode("row").alias("j", "value"))


@dataclass(frozen=True)
class Decomposition:
    """Truncated singular value decomposition: values, and right vectors as columns, the largest component of each positive."""

    values: np.ndarray
    right: np.ndarray

    def spectrum(self, spark: SparkSession) -> DataFrame:
        """``(rank, singular_value, eigenvalue)``, largest first."""
        rows = [(i + 1, float(s), float(s * s)) for i, s in enumerate(self.values)]
        return spark.createDataFrame(rows, "rank INT, singular_value DOUBLE, eigenvalue DOUBLE")

    def right_table(self, spark: SparkSession) -> DataFrame:
        """``(concept, term_id, weight)``."""
        rows = [(c, t, float(w)) for t, row in enumerate(self.right) for c, w in enumerate(row)]
        return spark.createDataFrame(rows, "concept INT, term_id INT, weight DOUBLE")


def _block_product(rows: DataFrame, width: int) -> Callable[[np.ndarray], np.ndarray]:
    """The product of the matrix of column products with a block of vectors, without that matrix: one pass over the rows.

    Each task adds its rows up in one block, which it sends in chunks of columns; the chunks of all tasks are added up as they
    stream into one task each.
    """

    def product(block: np.ndarray) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast(block)
        height = block.shape[1]

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, total = shared.value, np.zeros((width, height))
            for part in unpacked(batches, width):
                if part.dense is not None:
                    total += part.dense.T @ (part.dense @ block)
                    continue
                projected = np.zeros((part.size, height))
                add_entries(projected, part.row, part.at, part.x, block)
                order = part.ordered
                add_entries(total, part.at[order], part.row[order], part.x[order], projected)
            chunks = {c: total[c : c + CHUNK_COLUMNS] for c in range(0, width, CHUNK_COLUMNS)}
            yield from block_batches({c: block for c, block in chunks.items() if block.any()})

        out = np.zeros((width, height))
        for c, sums in added_up(rows.mapInArrow(multiply, SCHEMA)).items():
            out[c : c + CHUNK_COLUMNS] = sums.reshape(-1, height)
        shared.unpersist()
        return out

    return product


def _top_vectors(product: Callable[[np.ndarray], np.ndarray], width: int, k: int) -> np.ndarray:
    """The ``k`` leading vectors of a symmetric positive matrix given by its products, from a random block that grows by the
    residuals of what is not settled yet; a wide subspace is restarted from its best vectors."""
    height = min(width, k + OVERSAMPLE)
    space = np.linalg.qr(np.random.default_rng(0).standard_normal((width, height)))[0]
    image = product(space)
    for _ in range(MAX_PASSES):
        values, turn = np.linalg.eigh(space.T @ image)
        values, turn = values[::-1], turn[:, ::-1]
        best, best_image = space @ turn, image @ turn
        residual = best_image - best * values
        size = np.linalg.norm(residual, axis=0)
        if (size[:k] <= SETTLED * max(values[0], 1e-300)).all() or space.shape[1] == width:
            break
        if space.shape[1] + height > min(width, 6 * height):
            space, image = best[:, : 2 * height], best_image[:, : 2 * height]
        new = residual[:, :height]
        new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
        for _ in range(2):
            new = new - space @ (space.T @ new)
            left, sizes, _ = np.linalg.svd(new, full_matrices=False)
            new = left[:, sizes > 1e-10]
        if not new.shape[1]:
            break
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    return best[:, :k]


def _tall_factor(rows: DataFrame, right: np.ndarray) -> np.ndarray:
    """The triangular factor of the rows times ``right``: one per task, then of a few tasks' factors, then of those."""
    shared, (width, k) = rows.sparkSession.sparkContext.broadcast(right), right.shape

    def project_and_factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((0, k))
        for part in unpacked(batches, width):
            projected = np.zeros((part.size, k))
            if part.dense is not None:
                projected += part.dense @ shared.value
            else:
                add_entries(projected, part.row, part.at, part.x, shared.value)
            found = np.linalg.qr(np.vstack([found, projected]), mode="r")
        yield _matrix_batch(found)

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((0, k))
        for batch in batches:
            for m in batch.column(0).to_pylist():
                found = np.linalg.qr(np.vstack([found, np.frombuffer(m).reshape(-1, k)]), mode="r")
        yield _matrix_batch(found)

    parts = rows.mapInArrow(project_and_factor, "factor binary").repartition(TREE_TASKS).mapInArrow(factor, "factor binary")
    return np.linalg.qr(np.vstack([np.frombuffer(r.factor).reshape(-1, k) for r in parts.collect()]), mode="r")  # TREE_TASKS small ones


def _matrix_batch(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary())], names=["factor"])


def decompose(df: DataFrame, width: int, k: int, vector: str = "row", square_columns: int | None = None) -> Decomposition:
    """The ``k`` largest singular values of the uncentred rows: up to ``square_columns`` columns, by default ``MAX_COLUMNS``, by
    one pass over them."""
    if width > (MAX_COLUMNS if square_columns is None else square_columns):
        rows = packed_rows(df, width, vector)
        right = _top_vectors(_block_product(rows, width), width, min(k, width))
        _, values, turn = np.linalg.svd(_tall_factor(rows, right), full_matrices=False)
        right = right @ turn.T
    else:
        eigenvalues, vectors = np.linalg.eigh(gram_matrix(df, width, vector))
        order = np.argsort(eigenvalues)[::-1][:k]
        values, right = np.sqrt(np.clip(eigenvalues[order], 0.0, None)), vectors[:, order]
    kept = values > 1e-9 * max(values[0], 1e-300)
    right = right[:, kept]
    signs = np.where(right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])] < 0, -1.0, 1.0)
    return Decomposition(values[kept], right * signs)


def project_rows(df: DataFrame, loadings: np.ndarray, vector: str = "row") -> DataFrame:
    """``(doc_id, projection)``: sparse rows times a bounded terms-by-axes matrix, every document kept, no shuffle."""
    if loadings.nbytes > BROADCAST_BYTES:
        raise ValueError(f"loadings of {loadings.nbytes} bytes, more than {BROADCAST_BYTES}")
    return df.select("doc_id", project_sparse(vector, loadings).alias("projection"))


def project_on(df: DataFrame, loadings: list[list[float]], vector: str = "vector") -> DataFrame:
    """``(doc_id, projection)`` of dense vectors on outside loadings, one row of loadings per dimension."""
    return df.select("doc_id", project(vector, loadings).alias("projection"))


def standardise(df: DataFrame, vector: str = "vector", output: str = "standard") -> DataFrame:
    """Adds the vector with mean 0 and sample deviation 1 per column; a constant column becomes 0."""
    return _standardise(df.withColumn("_in", array_to_vector(F.col(vector).cast("array<double>"))), output).withColumn(
        output, vector_to_array(output)
    ).drop("_in")


def _standardise(df: DataFrame, output: str) -> DataFrame:
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_in", outputCol=output)
    return scaler.fit(df.select("_in")).transform(df)


def principal_components(
    df: DataFrame, k: int, vector: str = "vector", standardised: bool = True
) -> tuple[PCAModel, DataFrame]:
    """The fitted model and ``df`` with ``projection`` on the ``k`` main axes. Rows that are not standardised
    are projected as they are, without centring."""
    ready = df.withColumn("_in", array_to_vector(F.col(vector).cast("array<double>")))
    if standardised:
        ready = _standardise(ready, "_scaled")
    else:
        ready = ready.withColumn("_scaled", F.col("_in"))
    model = PCA(k=k, inputCol="_scaled", outputCol="_out").fit(ready.select("_scaled"))
    projected = model.transform(ready).withColumn("projection", vector_to_array("_out"))
    return model, projected.drop("_in", "_scaled", "_out")


def column_summary(df: DataFrame, vector: str = "vector") -> DataFrame:
    """``(dim, mean, variance, nonzeros, min, max, norm_l1, norm_l2)`` per component."""
    metrics = Summarizer.metrics("mean", "variance", "numNonZeros", "min", "max", "normL1", "normL2")
    names = {"mean": "mean", "variance": "variance", "numNonZeros": "nonzeros", "min": "min", "max": "max"}
    names |= {"normL1": "norm_l1", "normL2": "norm_l2"}
    one = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v")).select(metrics.summary(F.col("v")).alias("s"))
    arrays = [vector_to_array(f"s.{metric}").alias(name) for metric, name in names.items()]
    zipped = one.select(*arrays).select(F.posexplode(F.arrays_zip(*names.values())).alias("dim", "m"))
    return zipped.select("dim", *[F.col(f"m.{name}").alias(name) for name in names.values()])
