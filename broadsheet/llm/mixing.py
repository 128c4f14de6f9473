"""Mixing sources to target weights by entropy balancing.

Each document gets the rate nearest to its prior rate, in relative entropy per word, that makes every source give its
target number of words and draws the shares of other groups, such as languages, towards theirs. The rates are
``min(cap, prior * exp(sum of the multipliers of its groups))``; the multipliers solve a convex dual by Newton steps on the full
system, each one aggregation over the documents. Rates are then rounded into whole copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.sizing import driver_rows
from broadsheet.llm.rows import as_bytes, fresh_name, slices
from broadsheet.session import durable

MAX_SOURCES = 100_000  # a mix names its sources; more is an error, not a cut
BLOCK_DOCUMENTS = 4096
SOFTNESS = 0.05  # of a kept group's words: how little its share gives way to the targets of the sources
MOST_KINDS = 1000
STEPS = 60
TOLERANCE = 1e-9


def document_sizes(docs: DataFrame, kind: str | None = None) -> DataFrame:
    """``(doc_id, source, size)``, with the column ``kind`` as such if it is named: the number of words between ASCII white
    space; null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sizes = pa.array([len(t.split()) for t in as_bytes(piece.column(2))], pa.int64())
            yield pa.RecordBatch.from_arrays([*piece.columns[:2], sizes, *piece.columns[3:]], names=names)

    names = ["doc_id", "source", "size"] + ["kind"] * (kind is not None)
    more = [F.col(kind).cast("string").alias("kind")] if kind is not None else []
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, size bigint" + ", kind string" * len(more)
    return docs.select("doc_id", "source", "text", *more).mapInArrow(run, schema)


def targets(sizes: dict, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> dict:
    """Words wanted of each source: shares of all words by the repeating weights in order of code points, null last.

    No target exceeds ``cap`` times its source; what is above is shared again by weight among the others.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out: dict = {}
    left, open_ = float(sum(sizes.values())), list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def balance(sizes: DataFrame, wanted: dict, cap: float = 3.0, kept: dict | None = None, softness: float = SOFTNESS) -> tuple[dict, dict]:
    """Multipliers of the sources and of the kept groups. ``sizes`` has ``source, size, prior`` and, with ``kept``, ``kind``.

    The words of the sources in ``wanted`` are met; those of the groups in ``kept`` are drawn towards their values, by a square
    of their multipliers in the dual, whose weight is ``softness`` times the group's words: groups cut across sources, and
    no rates may meet both. The dual is the sum over documents of ``size * integral of rate`` minus multipliers times
    words wanted: its gradient is the words given minus the words wanted, its second derivatives are the words, below the
    cap, that two groups have in common. Steps are halved until the dual falls. A source alone with its multiplier is moved
    by a bracketed step, so that the iteration ends on any input.
    """
    kept = {k: v for k, v in (kept or {}).items() if v > 0}
    active = [s for s in wanted if wanted[s] > 0]
    names = [(0, s) for s in active] + [(1, k) for k in kept]
    goal = np.array([float(wanted[s]) for s in active] + [float(v) for v in kept.values()])
    weight = np.array([0.0] * len(active) + [softness * float(v) for v in kept.values()])
    at = {name: i for i, name in enumerate(names)}
    x = np.zeros(len(names))
    found = _dual(sizes, names, x, cap, at)
    for _ in range(STEPS):
        if not len(x):
            break
        value, given, square = found
        gradient = given + weight * x - goal
        if (np.abs(gradient) <= TOLERANCE * np.maximum(1.0, goal)).all():
            break
        ridge = 1e-12 * max(1.0, float(np.trace(square)) / len(x))
        step = np.linalg.solve(square + np.diag(weight + ridge), -gradient)
        step *= min(1.0, 4.0 / max(1e-300, np.abs(step).max()))
        now, share = value + weight @ x**2 / 2 - goal @ x, 1.0
        while True:
            tried = np.clip(x + share * step, -60.0, 60.0)
            found = _dual(sizes, names, tried, cap, at)
            if found[0] + weight @ tried**2 / 2 - goal @ tried <= now + 1e-9 * abs(now) or share < 1e-3:
                break
            share /= 2
        moved, x = np.abs(tried - x).max(), tried
        if moved < 1e-13:
            break
    out: tuple[dict, dict] = (dict.fromkeys(wanted, 0.0), {})
    for (which, key), m in zip(names, x.tolist(), strict=True):
        out[which][key] = round(m, 12)  # sums differ in their last digits from run to run
    return out


def _dual(sizes: DataFrame, names: list, x: np.ndarray, cap: float, at: dict) -> tuple[float, np.ndarray, np.ndarray]:
    """The dual without its linear part, words given by group, and words below the cap that two groups have in common."""
    spark = sizes.sparkSession
    grouped = "kind" in sizes.columns
    tables = [[(k, k is None, float(m)) for (w, k), m in zip(names, x, strict=True) if w == which] for which in (0, 1)]
    sources = F.broadcast(spark.createDataFrame(tables[0], "s string, s_none boolean, m double"))
    placed = sizes.join(sources, sizes["source"].eqNullSafe(F.col("s")))
    kind, tilt = F.lit(None).cast("string"), F.col("m")
    if grouped:
        kinds = F.broadcast(spark.createDataFrame(tables[1], "k string, k_none boolean, mk double"))
        placed = placed.join(kinds, sizes["kind"].eqNullSafe(F.col("k")), "left")
        kind, tilt = F.col("kind"), F.col("m") + F.coalesce("mk", F.lit(0.0))
    rate = F.col("prior") * F.exp(tilt)
    below = rate < cap
    size, top = F.col("size"), F.lit(float(cap))
    area = F.when(below, rate).otherwise(top * (1 + tilt + F.log(F.col("prior")) - math.log(cap)))
    sums = placed.groupBy("source", kind.alias("kind")).agg(
        F.sum(size * area).alias("area"), F.sum(size * F.least(top, rate)).alias("given"), F.sum(F.when(below, size * rate).otherwise(0.0)).alias("slope")
    )
    value, given, square = 0.0, np.zeros(len(x)), np.zeros((len(x), len(x)))
    for r in sums.collect():  # one row per source and kind
        own = [i for i in (at.get((0, r.source)), at.get((1, r.kind)) if grouped else None) if i is not None]
        value += r.area or 0.0
        given[own] += r.given
        square[np.ix_(own, own)] += r.slope
    return value, given, square


def _round(block: pd.DataFrame, cap: float) -> pd.DataFrame:
    """Copies of the documents of one block, long ones first: each document takes the whole number of copies that brings
    the running total nearest to the running expectation, so that what a long one misses its successors make up for."""
    block = block.sort_values(["size", "spread", "doc_id"], ascending=[False, True, True], ignore_index=True)
    expected = np.cumsum(block["rate"].to_numpy() * block["size"].to_numpy())
    copies = np.zeros(len(block), np.int64)
    taken = 0
    for i, size in enumerate(block["size"].to_numpy()):
        if size:
            copies[i] = min(int(cap), max(0, math.floor((expected[i] - taken) / size + 0.5)))
            taken += int(copies[i]) * int(size)
    return block.assign(copies=copies)[["doc_id", "source", "size", "copies"]]


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, prior: str | None = None, keep: str | None = None
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``.

    ``keep`` names a text column of few values, such as the language, whose shares of all words the mix keeps as far as the
    targets of the sources let it: documents of a value that the targets make rare get higher rates than others of their
    source. ``prior`` names a positive column with the rates to stay near to; without it all documents of a source are alike. Null
    and empty texts have size 0 and are taken 0 times; a source of no words has target 0. Repeated rows are documents of
    their own. The split into blocks follows from the data alone, so reruns agree. Blocks are pieces of a source of about
    ``BLOCK_DOCUMENTS`` rows, whatever the source's share of all rows.
    """
    sized = document_sizes(docs, keep)
    if prior is None:
        sized = sized.withColumn("prior", F.lit(1.0))
    else:
        rates = docs.select("doc_id", F.col(prior).cast("double").alias("prior")).groupBy("doc_id").agg(F.max("prior").alias("prior"))
        sized = sized.join(rates, "doc_id", "left").fillna(1.0, ["prior"])
    sized = durable(sized)
    spark = docs.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    rows = driver_rows(totals, MAX_SOURCES, "sources")
    wanted = targets({r.source: int(r["size"]) for r in rows}, weights, cap)
    kept = {}
    if keep is not None:
        kinds = driver_rows(sized.groupBy("kind").agg(F.sum("size").alias("size")), MOST_KINDS, keep)
        kept = {r.kind: float(r["size"]) * sum(wanted.values()) / max(1, sum(int(x["size"]) for x in kinds)) for r in kinds}
    of_source, of_kind = balance(sized, wanted, cap, kept)
    table = spark.createDataFrame(
        [(r.source, int(r["size"]), float(wanted[r.source]), float(of_source[r.source]), -(-r.n // BLOCK_DOCUMENTS)) for r in rows],
        "s string, source_size bigint, target double, m double, blocks bigint",
    )
    placed = _numbered_apart(sized).join(F.broadcast(table), sized["source"].eqNullSafe(F.col("s")))
    tilt = F.col("m")
    if keep is not None:
        kinds = spark.createDataFrame([(k, float(m)) for k, m in of_kind.items()], "k string, mk double")
        placed = placed.join(F.broadcast(kinds), F.col("kind").eqNullSafe(F.col("k")), "left")
        tilt = tilt + F.coalesce("mk", F.lit(0.0))
    spread = F.xxhash64("doc_id", "size", "member")
    rated = placed.select(
        "doc_id", "source", "size", F.least(F.lit(float(cap)), F.col("prior") * F.exp(tilt)).alias("rate"),
        spread.alias("spread"), F.pmod(spread, F.col("blocks")).alias("block"),
    )
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    rounded = rated.groupBy("source", "block").applyInPandas(
        lambda block: _round(block, cap), f"doc_id {id_kind}, source string, size bigint, copies bigint"
    )
    return rounded.join(F.broadcast(table), rounded["source"].eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _numbered_apart(sized: DataFrame) -> DataFrame:
    """Adds ``member``, which tells rows apart that agree in all columns: they are counted, and come back from their count, a
    bounded number at a time, so that rows of one id spread over the blocks like any others however the table is split."""
    counted = sized.groupBy(*sized.columns).agg(F.count("*").alias("rows"))
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("rows") - 1).cast("bigint"), F.lit(BLOCK_DOCUMENTS).cast("bigint"))))
    last = F.least(F.col("rows") - 1, F.col("part") + BLOCK_DOCUMENTS - 1)
    return parts.withColumn("member", F.explode(F.sequence("part", last))).drop("rows", "part")


def materialise(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with ``copy`` counting from 1. Ids have to be unique and not null."""
    number = fresh_name(docs.columns, "copy")
    copies = mixed.where("copies > 0").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(number))
    return docs.join(copies, "doc_id").select(*docs.columns, number)
