"""Encoding, spelling variants and whitening beside the tokenizers library, all pairs of words and numpy; and workers that
lack the package."""

import os
import random
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from broadsheet.llm import bpe, queries, spelling, whitening

ROOT = str(Path(__file__).resolve().parents[2])


# encoding


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    return bpe.Tokenizer.load(vocabulary)


def library(vocabulary, texts):
    import tokenizers

    own = tokenizers.Tokenizer.from_file(vocabulary)
    found = own.encode_batch(texts, add_special_tokens=False)
    return [(f.ids, own.decode(f.ids, skip_special_tokens=False)) for f in found]


def same(tokenizer, vocabulary, texts):
    packed = tokenizer.encoder()([t.encode() for t in texts])
    mine = [(np.frombuffer(p, "<u4").tolist(), tokenizer.decode(p)) for p in packed]
    return [t for t, a, b in zip(texts, mine, library(vocabulary, texts), strict=True) if a != b]


def test_every_code_point_is_encoded_as_by_the_library(tokenizer, vocabulary):
    texts = [f"a{chr(c)}b{chr(c)} {chr(c)}" for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    assert same(tokenizer, vocabulary, texts) == []


def test_mixed_and_long_words_are_encoded_as_by_the_library(tokenizer, vocabulary):
    rng = random.Random(3)
    parts = [*map(chr, range(0x180)), "<|endoftext|>", "<|startoftext|>", "<|end", "'s", "'LL", " ", "\n", "Σ", "é", "中", "🙂", "7", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    texts += ["", " ", "ab" * 700, "x" * 3000, "-" * 999 + "a", "the" * 22, "é" * 200, "<|endoftext|>" * 3, "Straße İstanbul ΑΣ"]
    assert same(tokenizer, vocabulary, texts) == []


@pytest.mark.parametrize("word", [b"a", b"the", b"unbelievable", b"a" * 63, bytes(range(200, 256)), b"abcab" * 12])
def test_array_and_heap_agree(tokenizer, word):
    assert tokenizer.merge_short([word, b"zz", word])[::2] == [tokenizer.merge_long(word)] * 2


def test_encoded_rows(spark, tokenizer, vocabulary):
    texts = [None, "", "Hello  world", "Hello  world", "word " * 50_000]
    docs = spark.createDataFrame([(i % 4, t) for i, t in enumerate(texts)], "id int, text string").selectExpr("*", "1 AS tokens", "2 AS decoded")
    out, name = bpe.encode_texts(docs, tokenizer)
    assert name == "tokens_" and out.columns == [*docs.columns, name]
    back, decoded = bpe.decode_ids(out.selectExpr("id", "text", "decoded", "tokens_.ids AS ids", "tokens_.n_tokens AS n"), tokenizer)
    got = sorted((r.id, r.text or "", r.n, r[decoded].text) for r in back.collect())
    assert got == sorted((i % 4, t or "", len(a), b) for i, (t, (a, b)) in enumerate(zip(texts, library(vocabulary, [t or "" for t in texts]), strict=True)))
    assert bpe.encode_texts(docs.limit(0), tokenizer)[0].count() == 0


def test_other_kinds_of_vocabularies_are_refused(vocabulary):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Tokenizer.load(public_tokenizers.path("byte_bpe_50k.json"))


# spelling variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts, ratio=10):
    forms, rows = {}, {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        rows[w] = len(others)
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, n, forms[w], counts.get(forms[w]), rows[w], root))
    return sorted(out, key=str)


def test_variants_equal_all_pairs(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(3, 6))) for _ in range(400)}
    words |= {"spelling" * 6000, "spelling" * 6000 + "s", "", "x", "a", "ß", "🙂🙃", "🙂"}
    counts = {w: rng.choice([1, 1, 2, 11, 15, 120, 1300, 15000]) for w in sorted(words)}
    table = spark.createDataFrame([*counts.items(), (None, 7)], "word string, n bigint").selectExpr("*", "'k' AS key", "0 AS slot", "9 AS id")
    got = sorted((tuple(r) for r in spelling.variants(table).collect()), key=str)
    assert got == brute_variants(counts)
    assert any(r[5] != r[0] and r[5] != r[2] for r in got)  # a chain of forms
    assert spelling.variants(table.limit(0)).count() == 0


def test_one_alphabet_symbol_finds_the_same(spark):
    counts = {"abcdefg": 100, "abcdefh": 3, "abcdef": 1, "bacdefg": 5, "zzzzzzz": 50}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    for symbols in (1, 2, 16):
        assert sorted(map(tuple, spelling.variants(table, symbols=symbols).collect()), key=str) == brute_variants(counts)


def test_counted_words(spark):
    rows = [(1, "Réunion RÉUNION réunion, short"), (1, "Réunion RÉUNION réunion, short"), (None, "Letters LETTERS"), (2, None), (3, ""), (4, "x" * 200_000 + " " + "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'n' AS n", "'w' AS word")
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert got == {"réunion": 4, "rÉunion": 2, "letters": 2, "x" * 200_000: 2}
    slipped = Counter()
    for i in range(400):
        word = "abcdefgh"
        mark = zlib.crc32(f"{i}:{word}".encode())
        slipped[word if mark % 31 else word[: mark % 8] + word[mark % 8 + 1 :]] += 1
    many = spark.range(400).selectExpr("id AS doc_id", "'abcdefgh' AS text")
    assert {r.word: r.n for r in spelling.word_counts(many, "text", "doc_id", queries.slipped, least_count=1).collect()} == dict(slipped)
    assert len(slipped) > 1


# whitening


def spectra():
    rng = np.random.default_rng(1)
    yield "plain", np.cov(rng.standard_normal((64, 500)), bias=True), 16
    yield "narrow", np.cov(rng.standard_normal((5, 50)), bias=True), 16
    yield "rank 3", (lambda a: a @ a.T)(rng.standard_normal((40, 3))), 16
    yield "equal", np.eye(30) * 4, 16
    yield "wide", np.cov(rng.standard_normal((300, 900)) * np.geomspace(1, 1e-4, 300)[:, None], bias=True), 8
    yield "single", np.array([[2.0]]), 16


@pytest.mark.parametrize("name, matrix, k", list(spectra()), ids=lambda v: v if isinstance(v, str) else "")
def test_eigenvectors_are_of_double_precision(name, matrix, k):
    values, vectors = whitening.jacobi_davidson(lambda b: matrix @ b, len(matrix), k)
    true = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    assert len(values) == min(k, len(matrix))
    assert np.abs(values - true).max() <= 1e-13 * true[0]
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    a = np.diag(np.linspace(-3, 5, 20))
    right = rng.standard_normal((20, 3))
    shift = np.array([0.1, -1.3, 2.2])
    t = whitening.minres(lambda b: a @ b, shift, lambda x: x, right, 40)
    assert np.abs(a @ t - t * shift - right).max() < 1e-8


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'w' AS whole", "'x' AS white")


def test_whitened_rows_equal_numpy(spark):
    rng = np.random.default_rng(4)
    data = (rng.standard_normal((300, 6)) * [5, 4, 3, 2, 1, 0.5]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(0, data[0].tolist())] * 200  # repeats do not weigh
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (905, [1.0])]
    docs, whole, width = whitening.whole_vectors(vectors_of(spark, rows + bad + [(None, data[1].tolist())]), "embedding")
    assert (whole, width) == ("whole_", 6)
    model = whitening.fit_whitening(docs, whole, width, 4)
    out, name = whitening.whiten(docs, whole, width, model)
    got = out.collect()
    x = np.floor(64 * data.astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, turn = np.linalg.eigh(np.cov(fit.T, bias=True))
    want = ((n * x - sums) / n) @ turn[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    assert len(got) == 501 and model.centre.n == n and model.identity_error < 1e-12
    assert abs(model.trace / values.sum() - 1) < 1e-12
    for r in got:
        i = 1 if r.vec_id is None else r.vec_id
        assert r[name].deviation == int(((n * x[i] - sums) ** 2).sum())
        assert np.abs(np.abs(r[name].whitened) - np.abs(want[i])).max() < 1e-9


def test_vectors_without_spread_and_empty_tables(spark):
    for rows, n in [([], 0), ([(1, None)], 0), ([(1, [1.0, 2.0])] * 3, 3)]:
        docs, whole, width = whitening.whole_vectors(vectors_of(spark, rows), "embedding")
        model = whitening.fit_whitening(docs, whole, width)
        out, name = whitening.whiten(docs, whole, width, model)
        assert [list(r[name].whitened) for r in out.collect()] == [[]] * n


def test_deviations_beyond_a_long_are_null():
    centre = whitening.Centre(10**10, [10**16, 0])
    assert centre.deviations(np.array([[10**6, 0], [10**6 + 1, 0]])) == [0, None]
    big = whitening.Centre(3, [1, 1])
    assert big.deviations(np.array([[10**9, 5]])) == [(3 * 10**9 - 1) ** 2 + 14**2]
    edge = whitening.Centre(1, [0])
    assert edge.deviations(np.array([[3037000499], [3037000500]])) == [3037000499**2, None]


# workers without the package


def test_operators_run_on_workers_that_lack_the_package(tmp_path):
    """The driver finds the package by ``sys.path`` only, which workers do not inherit."""
    code = f"""
import sys
sys.path[:0] = [{ROOT!r}]
import __spark_entry__
from broadsheet.session import local_session
spark = local_session(4)
spark.sparkContext.setLogLevel("OFF")

def lacks(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("broadsheet") is not None]}})

assert [r.found for r in spark.range(1).mapInArrow(lacks, "found boolean").collect()] == [False]
for name, query in __spark_entry__.queries().items():
    if name.startswith("op"):
        rows = query(spark, "/root/testdata/sf0.001").count()
        assert rows > 0, name
        print(name, rows)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("op") >= 13
