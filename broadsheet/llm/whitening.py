"""Whitening of embeddings by their leading covariance eigenvectors, found by a block Jacobi-Davidson method.

The covariance matrix is never formed. Its products with a block of vectors are one pass of Spark over the centred rows; the
driver holds only blocks of ``width x few`` numbers. A subspace of growing width is searched: Rayleigh-Ritz gives the best
pairs in it, pairs whose residual has reached double precision are locked, and for the next ones the projected correction
equation ``(I - QQ')(V - theta I)(I - QQ') t = -r`` is solved by inner MINRES, all of a block side by side, so that an inner
step is one pass as well. The corrections widen the subspace; a wide one is restarted from its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.rows import fresh_name, shared
from broadsheet.session import durable

COMPONENTS = 16
INNER_STEPS = 8
MAX_OUTER = 200
#: A residual counts as double precision below this many units in the last place of the largest eigenvalue.
UNITS = 32
BATCH_VALUES = 1 << 20
LONG = np.iinfo(np.int64)

Product = Callable[[np.ndarray], np.ndarray]


def _rows(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """Vectors of a batch as matrices of bounded size."""
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    step = max(1, BATCH_VALUES // width)
    for a in range(0, len(flat), step):
        yield flat[a : a + step]


@dataclass
class Centre:
    """Mean of whole-number vectors as a whole part and a rest: the mean is ``floor + rest / n`` exactly."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.shift = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` minus the mean; the whole part is taken off in whole numbers, so that nothing of the spread is rounded away."""
        return (x - self.floor).astype(float) - self.shift

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - sum) ** 2`` in whole numbers; null where it does not fit into a long."""
        far = x - self.floor
        most = int(np.abs(far).max(initial=0)) + 1
        if self.n * most < 1 << 31 and x.shape[1] * (self.n * most) ** 2 < LONG.max:
            d = self.n * far - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = far.astype(object) * self.n - np.array(self.rest, object)
        return [v if v <= LONG.max else None for v in (d * d).sum(axis=1).tolist()]


@dataclass
class Whitening:
    """Eigenvectors are the columns of ``vectors``, eigenvalues fall."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.vectors / np.sqrt(self.values))


def whole_vectors(rows: DataFrame, vector: str, scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, str, int]:
    """All usable rows and a column of whole-number vectors ``floor(scale * c) + offset``, its name, and their width.

    Rows whose vector is null or empty, or holds null or non-finite entries, are dropped. If lengths differ, the most frequent
    one counts (ties: the longest) and rows of others are dropped. Entries beyond a long are set to its ends.
    """
    c = F.col(vector).cast("array<double>")
    fine = F.col(vector).isNotNull() & F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & (F.size(c) > 0)
    some = rows.where(fine)
    sizes = some.groupBy(F.size(vector).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = sizes.width if sizes else 0
    name = fresh_name(rows.columns, "whole")
    whole = F.transform(c, lambda v: F.least(F.greatest(F.floor(v * scale), F.lit(-(1 << 62))), F.lit(1 << 62)) + F.lit(offset).cast("bigint"))
    return some.where(F.size(vector) == width).withColumn(name, whole), name, width


def _sums(rows: DataFrame, width: int, make: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
    """Adds up, over all rows, the ``(width, columns)`` matrices that ``make`` gives for pieces of them.

    Each task sends one matrix, a row of it a row, and these are added by key; the driver gets one matrix.
    """
    names = [f"v{i}" for i in range(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _rows(batch, width):
                part = make(x)
                total = part if total is None else total + part
        if total is not None:
            arrays = [pa.array(np.arange(len(total))), *[pa.array(np.ascontiguousarray(total[:, i])) for i in range(columns)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", *names])

    parts = rows.mapInArrow(run, ", ".join(["i bigint", *[f"{v} double" for v in names]]))
    out = np.zeros((width, columns))
    for r in parts.groupBy("i").agg(*[F.sum(v).alias(v) for v in names]).collect():  # one row per dimension
        out[r.i] = r[1:]
    return out


def _centre(fit: DataFrame, name: str, width: int) -> Centre | None:
    """Exact number and sums of the distinct vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, object)
        for batch in batches:
            for x in _rows(batch, width):
                safe = int(np.abs(x).max(initial=0)) * len(x) < LONG.max
                n, sums = n + len(x), sums + (x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0))
        yield pa.RecordBatch.from_pydict({"i": list(range(width)), "n": [n] * width, "s": [str(s) for s in sums]}, schema=pa.schema([("i", pa.int64()), ("n", pa.int64()), ("s", pa.string())]))

    parts = fit.select(name).mapInArrow(run, "i bigint, n bigint, s string")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return Centre(rows[0].n, [int(r.s) for r in rows]) if rows and rows[0].n else None


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Directions of ``new`` that are not in the spans of ``against``, orthonormal to double precision."""
    scale = np.linalg.norm(new, axis=0)
    new = new[:, scale > 0] / scale[scale > 0]
    for _ in range(3):
        for q in against:
            new = new - q @ (q.T @ new)
        u, s, _ = np.linalg.svd(new, full_matrices=False)
        new = u[:, s > 1e-8] if len(s) else new[:, :0]
    return new


def minres(product: Product, shift: np.ndarray, project: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Solves ``P (V - shift_j) P t_j = right_j`` for all columns j side by side by ``steps`` steps of MINRES.

    Columns that have broken down or converged stand still. One product of ``V`` with the whole block a step.
    """
    t = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    on = beta > 0
    v_old, v = np.zeros_like(right), right / np.where(on, beta, 1)
    d_old, d_older = np.zeros_like(right), np.zeros_like(right)
    c_old, c, s_old, s = -np.ones(len(beta)), -np.ones(len(beta)), np.zeros(len(beta)), np.zeros(len(beta))
    eta, beta_now = beta.copy(), np.zeros(len(beta))
    first = beta.copy()
    for _ in range(steps):
        if not on.any():
            break
        w = project(product(v) - v * shift)
        alpha = (v * w).sum(axis=0)
        w = w - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(w, axis=0)
        # two earlier rotations applied to the new column of the tridiagonal matrix, then one that clears its last entry
        eps = s_old * beta_now
        bar = -c_old * beta_now
        delta = c * bar + s * alpha
        gamma_bar = s * bar - c * alpha
        gamma = np.hypot(gamma_bar, beta_next)
        use = on & (gamma > 0)
        safe = np.where(use, gamma, 1)
        c_new, s_new = np.where(use, gamma_bar / safe, 1), np.where(use, beta_next / safe, 0)
        d = (v - delta * d_old - eps * d_older) / safe
        t = t + np.where(use, c_new * eta, 0) * d
        eta = s_new * eta
        d_older, d_old = d_old, d
        c_old, c, s_old, s = c, c_new, s, s_new
        on = use & (beta_next > 1e-15 * np.abs(alpha)) & (np.abs(eta) > 1e-10 * first)
        v_old, v = v, np.where(on, w / np.where(beta_next > 0, beta_next, 1), 0)
        beta_now = beta_next
    return t


def jacobi_davidson(product: Product, width: int, wanted: int, inner: int = INNER_STEPS, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and eigenvectors of a symmetric matrix given by its products with blocks.

    Ends when every residual is at double precision; raises if that takes more than ``MAX_OUTER`` rounds.
    """
    wanted = min(wanted, width)
    widest, kept = min(width, 4 * wanted), min(width, 2 * wanted)
    space = _orthonormal(start if start is not None else np.random.default_rng(7).standard_normal((width, min(width, wanted + 4))))
    image = product(space)
    for _ in range(MAX_OUTER):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, ritz_image = space @ turn, image @ turn
        top = ritz[:, :wanted]
        residual = ritz_image[:, :wanted] - top * values[:wanted]
        size = np.linalg.norm(residual, axis=0)
        locked = size <= UNITS * np.finfo(float).eps * max(abs(values[0]), np.finfo(float).tiny)
        if locked.all() or space.shape[1] == width:
            return values[:wanted], top
        if space.shape[1] + (~locked).sum() > widest:
            space, image = ritz[:, :kept], ritz_image[:, :kept]
        open_, fixed = top[:, ~locked], top

        def project(x: np.ndarray, q: np.ndarray = fixed) -> np.ndarray:
            return x - q @ (q.T @ x)

        more = minres(product, values[:wanted][~locked], project, -project(residual[:, ~locked]), inner)
        more = _orthonormal(np.where(np.linalg.norm(more, axis=0) > 0, more, residual[:, ~locked]), space, open_)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(space.shape[1]).standard_normal((width, open_.shape[1])), space)
        more = more[:, : max(1, width - space.shape[1])]
        space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    raise RuntimeError("eigenvectors did not settle")


def fit_whitening(rows: DataFrame, whole: str, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Fits on the distinct vectors of the column ``whole``; None without any.

    Components whose eigenvalue is zero to double precision cannot be scaled to one and are left out. Eigenvectors have their
    largest entry positive. Repeated vectors are counted in the tasks before they are shuffled.
    """
    if not width:
        return None
    spark = rows.sparkSession
    fit = durable(rows.select(whole).distinct())
    centre = _centre(fit, whole, width)
    if centre is None:
        return None
    held = shared(spark, centre)

    def products(block: np.ndarray) -> np.ndarray:
        def make(x: np.ndarray) -> np.ndarray:
            c = held().centred(x)
            return c.T @ (c @ block)

        return _sums(fit, width, make, block.shape[1]) / centre.n

    trace = float(_sums(fit, width, lambda x: (held().centred(x) ** 2).sum(axis=0)[:, None], 1).sum()) / centre.n
    values, vectors = jacobi_davidson(products, width, components) if trace > 0 else (np.zeros(0), np.zeros((width, 0)))
    real = values > width * np.finfo(float).eps * max(values, default=0)
    values, vectors = values[real], vectors[:, real]
    if values.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    found = Whitening(centre, vectors, values, trace, 0.0)
    if values.size:
        scaled = vectors / np.sqrt(values)

        def gram(x: np.ndarray) -> np.ndarray:
            w = held().centred(x) @ scaled
            return w.T @ w

        square = _sums(fit, width, lambda x: np.vstack([gram(x), np.zeros((width - len(values), len(values)))]), len(values))
        found.identity_error = float(np.abs(square[: len(values)] / centre.n - np.eye(len(values))).max())
    return found


def whiten(rows: DataFrame, whole: str, width: int, model: Whitening | None) -> tuple[DataFrame, str]:
    """All columns of ``rows`` and a struct with ``whitened``, one number per component, and the exact ``deviation``; its name
    is returned too. Without a model there are no rows."""
    name = fresh_name(rows.columns, "white")
    kind = "struct<whitened: array<double>, deviation: bigint>"
    if model is None:
        return rows.where(F.lit(False)).withColumn(name, F.lit(None).cast(kind)), name
    get = shared(rows.sparkSession, model)
    at = rows.columns.index(whole)
    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = get()
        for batch in batches:
            start = 0
            for x in _rows(batch.select([at]), width):
                piece = batch.slice(start, len(x))
                start += len(x)
                columns = [pa.array(list(m.whiten(x)), pa.list_(pa.float64())), pa.array(m.centre.deviations(x), pa.int64())]
                added = pa.StructArray.from_arrays(columns, names=["whitened", "deviation"])
                yield pa.RecordBatch.from_arrays([*piece.columns, added], names=[*piece.schema.names, name])

    return rows.mapInArrow(run, schema), name
