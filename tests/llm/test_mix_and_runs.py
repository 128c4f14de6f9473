"""Mixing under groups that cut across sources, rows that agree in everything, and runs that no join shuffles."""

import random
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import line_dedup, mixing, queries

SMALL = Path("/root/testdata/sf0.01")


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight; sources above the cap are fixed one after the other, the largest excess first."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        total = sum(weight[s] for s in order if s not in fixed)
        share = {s: Fraction(left * weight[s], total) for s in order if s not in fixed}
        over = [s for s in share if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        worst = max(over, key=lambda s: share[s] / max(1, cap * sizes[s]))
        fixed[worst] = cap * sizes[worst]


@pytest.mark.skipif(not SMALL.exists(), reason="needs the test tables")
def test_sizes_and_targets_of_the_query(spark):
    import duckdb

    docs = f"{SMALL}/documents.parquet"
    words = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))"
    wanted = {i: (n, s, source) for i, source, n, s in duckdb.sql(f"SELECT doc_id, source, n, sum(n) OVER (PARTITION BY source) FROM (SELECT doc_id, source, {words} AS n FROM '{docs}')").fetchall()}
    targets = brute_targets({source: int(s) for _, s, source in wanted.values()})
    got = queries.op5_mixing(spark, str(SMALL)).collect()
    assert len(got) == len(wanted)
    for r in got:
        n, s, source = wanted[r.doc_id]
        assert (r["size"], r.source_size) == (n, s) and r.target == pytest.approx(float(targets[source]))
        assert 0 <= r.taken <= 3 * n and r.taken % max(1, n) == 0
    taken = {}
    for r in got:
        taken[wanted[r.doc_id][2]] = taken.get(wanted[r.doc_id][2], 0) + r.taken
    assert all(abs(taken[s] - float(t)) <= 0.01 * float(t) for s, t in targets.items())


def test_kept_groups_tilt_the_rates_within_a_source(spark):
    """Source a, nearly all of one language, is wanted more: without a tilt the other language would lose its share."""
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(5, 50), "a" if i % 2 else "b", "x" if i % 2 and i % 20 > 1 else "y") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")

    def shares(keep):
        mixed = mixing.mix(docs, (5, 1), keep=keep).join(docs.select("doc_id", "lang"), "doc_id")
        by = {r.lang: r.n for r in mixed.groupBy("lang").agg(F.sum("taken").alias("n")).collect()}
        off = [abs(r.n - r.t) / r.t for r in mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()]
        assert max(off) < 0.01
        return by["y"] / sum(by.values())

    before = sum(len(t.split()) for _, t, _, lang in rows if lang == "y") / sum(len(t.split()) for _, t, *_ in rows)
    plain, kept = shares(None), shares("lang")
    # of a, no more than the cap allows of its few documents in y
    assert plain < before - 0.2 and plain + 0.05 < kept < before


def test_newton_meets_the_conditions_of_the_dual(spark):
    """Words given by source equal those wanted; those of a kept group miss theirs by softness times words times multiplier."""
    rng = np.random.default_rng(0)
    rows = [(f"s{i % 3}", int(rng.integers(1, 400)), float(rng.uniform(0.5, 2)), f"k{rng.integers(0, 4)}") for i in range(900)]
    sizes = spark.createDataFrame(rows, "source string, size bigint, prior double, kind string")
    total = sum(r[1] for r in rows)
    wanted = {"s0": 0.6 * total, "s1": 0.3 * total, "s2": 0.1 * total}
    kept = {"k0": 0.4 * total, "k1": 0.3 * total, "k2": 0.2 * total, "k3": 0.1 * total}
    m, mk = mixing.balance(sizes, wanted, 3.0, kept, softness=0.1)
    rate = [min(3.0, p * np.exp(m[s] + mk[k])) for s, _, p, k in rows]
    for s, t in wanted.items():
        assert sum(n * r for (own, n, *_), r in zip(rows, rate) if own == s) == pytest.approx(t, rel=1e-8)
    for k, t in kept.items():
        assert sum(n * r for (_, n, _, own), r in zip(rows, rate) if own == k) + 0.1 * t * mk[k] == pytest.approx(t, rel=1e-8)
    assert mixing.balance(sizes.limit(0), {}, 3.0, {}) == ({}, {})


def test_rows_that_agree_in_everything_spread_over_blocks(spark):
    rows = [(None, "one two three", "a", None)] * 9000 + [(7, "one two", "a", "x")] * 9000 + [(i, "w", "b", "y") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    apart = mixing._numbered_apart(mixing.document_sizes(docs, "lang"))
    assert apart.count() == len(rows) and apart.groupBy("doc_id", "source", "size", "kind", "member").count().where("count > 1").count() == 0
    blocks = apart.where("source = 'a'").groupBy(F.pmod(F.xxhash64("doc_id", "size", "member"), F.lit(5))).count().collect()
    assert len(blocks) == 5 and max(r["count"] for r in blocks) < 5000
    got = mixing.mix(docs, keep="lang")
    assert got.count() == len(rows)
    again = mixing.mix(docs.repartition(7), keep="lang")
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_materialised_copies(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1), "ab"[i % 2]) for i in range(40)], "doc_id bigint, text string, source string").selectExpr("*", "'z' AS copy")
    mixed = mixing.mix(docs)
    out = mixing.materialise(docs, mixed)
    assert out.columns == [*docs.columns, "copy_"]
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    found = {}
    for r in out.collect():
        found.setdefault(r.doc_id, []).append(r.copy_)
    assert {i: sorted(c) for i, c in found.items()} == {i: list(range(1, n + 1)) for i, n in copies.items() if n}


def test_runs_are_neither_shuffled_nor_sorted(spark, monkeypatch):
    rng = random.Random(6)
    lines = [f"a line of text that is long enough, number {i}" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))) for i in range(300)]
    keys = line_dedup.document_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), 5)
    runs = line_dedup.Runs(spark, fan_out=2)
    plans = []
    write = runs._write

    def watched(out):
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
        return write(out)

    monkeypatch.setattr(runs, "_write", watched)
    stored = keys.cache()
    for batch in range(5):
        runs.add(stored.where(F.col("batch") == batch).select("h1", "h2", "doc_id"))
    merges = [p for p in plans if "FullOuter" in p]
    batches = [p for p in plans if "FullOuter" not in p]
    assert len(merges) == 3 and len(batches) == 5
    assert all("Exchange" not in p and "Sort [" not in p for p in merges)
    assert all(p.count("Exchange hashpartitioning") == 2 for p in batches)  # distinct documents of a key, then the key
    assert all(p.count("Sort [") <= 1 for p in batches)  # the batch itself
    got = {(r.h1, r.h2): (r.n, r["last"]) for r in runs.totals().collect()}
    held = {}
    for r in stored.collect():
        held.setdefault((r.h1, r.h2), set()).add(r.doc_id)
    assert got == {k: (len(v), max(v)) for k, v in held.items()}
    runs.forget()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("run_")]
