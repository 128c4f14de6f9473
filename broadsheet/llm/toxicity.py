"""Toxicity by a linear classifier that is kept indifferent to which group a sentence names.

Features are words and beginnings of words that differ between the classes, each scaled by what is sure of its log ratio: a
feature that copies of few documents made frequent weighs little, while one sure word suffices. In the labelled texts
identity terms are swapped for others; the loss adds the squared change of the score, so that naming a group does not by
itself raise it.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.decontaminate import words_of
from broadsheet.llm.rows import as_bytes, shared, slices, with_struct
from broadsheet.llm.samples import labelled_sample
from broadsheet.session import durable

MAX_TRAIN = 8000  # labelled documents that the model is fitted on, at the utmost
MAX_FEATURES = 2048  # of the largest chi-square
LEAST_DOCUMENTS = 4
LEAST_CHI = 10.0
PREFIXES = (4, 5, 6, 7, 8)
PENALTY = 2.0  # of a squared change of score by swapping
L2 = 0.002
TERM_SCALE = 0.5  # least scale of a feature of an identity term
SURE = 2.5  # standard errors on either side of the share of documents that have a feature
STEPS = 400
CACHED_WORDS = 500_000
THRESHOLD = 0.7

#: Terms that name groups without saying anything about them; each line is one kind, within which terms are swapped.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys", "woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
)


def _feature(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def features_of(word: bytes) -> list[int]:
    """The word itself and its beginnings, as hashes."""
    out = [_feature(b"w" + word)]
    if not word.isascii():
        text = word.decode("utf-8", "ignore")
        return out + [_feature(b"p" + text[:k].encode()) for k in PREFIXES if len(text) >= k]
    return out + [_feature(b"p" + word[:k]) for k in PREFIXES if len(word) >= k]


def swapped(text: bytes, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> bytes | None:
    """The text with every identity term replaced by the next of its kind; None if it has none."""
    following = {a.encode(): b.encode() for kind in terms for a, b in zip(kind, [*kind[1:], kind[0]], strict=True)}
    pattern = re.compile(rb"(?<![0-9A-Za-z\x80-\xff])(" + b"|".join(sorted(following, key=len, reverse=True)) + rb")(?![0-9A-Za-z\x80-\xff])", re.I)
    out, n = pattern.subn(lambda m: following.get(m[1].lower(), m[1]), text)
    return out if n else None


def renamed(words: set[bytes], text: bytes, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> tuple[set[bytes], set[bytes]]:
    """Two versions of a text's words that name different groups: as they are and ``swapped``; without identity terms, with
    one of two neighbouring terms of a kind added, dealt out by the text's hash."""
    kinds = [[t.encode() for t in kind] for kind in terms if len(kind) > 1]
    if not kinds:
        return words, words
    following = {a: b for kind in kinds for a, b in zip(kind, [*kind[1:], kind[0]], strict=True)}
    if not words.isdisjoint(following):
        return words, {following.get(w, w) for w in words}
    named = sorted(following)
    term = named[zlib.crc32(text) % len(named)]
    return words | {term}, words | {following[term]}


@dataclass
class Model:
    features: dict[int, int]
    weights: np.ndarray
    bias: float

    def counts(self, text: bytes, cache: dict[bytes, tuple[int, ...]]) -> dict[int, int]:
        """Per feature of the model the number of distinct words that have it."""
        return self.counts_of(set(words_of(text)), cache)

    def counts_of(self, words: set[bytes], cache: dict[bytes, tuple[int, ...]]) -> dict[int, int]:
        out: dict[int, int] = {}
        for word in words:
            known = cache.get(word)
            if known is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                known = cache[word] = tuple(i for f in features_of(word) if (i := self.features.get(f)) is not None)
            for i in known:
                out[i] = out.get(i, 0) + 1
        return out

    def score(self, text: bytes, cache: dict[bytes, tuple[int, ...]]) -> float:
        z = self.bias + sum(self.weights[i] * math.log1p(n) for i, n in self.counts(text, cache).items())
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, float(z)))))


def _chosen(sample: DataFrame, most: int, terms: Sequence[Sequence[str]]) -> dict[int, float]:
    """Features of the largest chi-square between the classes of the sample and those of ``terms``, and the scale of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 128):
            total: dict[int, list[int]] = {}
            for text, y in zip(as_bytes(piece.column(0)), piece.column(1).to_pylist(), strict=True):
                for f in {f for w in set(words_of(text)) for f in features_of(w)}:
                    total.setdefault(f, [0, 0])[y > 0] += 1
            columns = [list(total), [x[1] for x in total.values()], [x[0] for x in total.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["f", "pos", "neg"])

    n = sample.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("pos"), F.count("*").alias("n")).first()
    p, q = float(n.pos), float(n.n - n.pos)
    if not p or not q:
        return {}
    counts = sample.select("text", "y").mapInArrow(run, "f bigint, pos bigint, neg bigint").groupBy("f").agg(F.sum("pos").alias("a"), F.sum("neg").alias("b"))
    both = F.col("a") + F.col("b")
    chi = (p + q) * F.pow(F.col("a") * q - F.col("b") * p, 2) / (both * (p + q - both) * p * q)
    kept = durable(counts.where((both >= LEAST_DOCUMENTS) & (both < p + q)).select("f", "a", "b", chi.alias("chi")))
    rows = kept.where(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "f").limit(most).collect()
    chosen = {r.f: _scale(r.a, r.b, p, q) for r in rows}
    naming = sorted({f for kind in terms for t in kind for f in features_of(t.encode())})
    for r in kept.where(F.col("f").isin(naming)).orderBy("f").collect():
        chosen[r.f] = max(TERM_SCALE, _scale(r.a, r.b, p, q))
    return chosen


def _bounds(k: int, n: float) -> tuple[float, float]:
    """Wilson bounds of a share of ``k`` in ``n``."""
    z2 = SURE * SURE
    half = SURE * math.sqrt(k * (n - k) / n + z2 / 4)
    return max(1e-12, (k + z2 / 2 - half) / (n + z2)), (k + z2 / 2 + half) / (n + z2)


def _scale(a: int, b: int, p: float, q: float) -> float:
    """The log of how much more frequent a feature is at least in one class, when ``a`` of ``p`` toxic and ``b`` of ``q`` other
    documents have it; 0 when the bounds of the two shares overlap."""
    (low_a, high_a), (low_b, high_b) = _bounds(a, p), _bounds(b, q)
    return max(0.0, math.log(low_a / high_b), math.log(low_b / high_a))


def fit(
    sample: DataFrame, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, penalty: float = PENALTY, most_features: int = MAX_FEATURES
) -> Model:
    """A model from ``(doc_id, text, y)`` rows, whose number the caller bounds: the driver gets the chosen features of each.

    With one class only, or none, the score is that class's share (a half without any row) for every text.
    """
    sample = durable(sample)
    chosen = _chosen(sample, most_features, terms)
    empty = Model({f: i for i, f in enumerate(chosen)}, np.zeros(len(chosen)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for piece in slices(batches, 128):
            rows = []
            for text in as_bytes(piece.column(1)):
                words = set(words_of(text))
                x = empty.counts_of(words, cache)
                one, other = (empty.counts_of(w, cache) for w in renamed(words, text, terms))
                change = {i: d for i in sorted(one.keys() | other.keys()) if (d := math.log1p(one.get(i, 0)) - math.log1p(other.get(i, 0)))}
                rows.append((list(x), list(x.values()), list(change), list(change.values())))
            arrays = [pa.array([r[i] for r in rows], pa.list_(k)) for i, k in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), *arrays], names=["doc_id", "y", "f", "n", "changed", "by"])

    kinds = "doc_id bigint, y int, f array<int>, n array<int>, changed array<int>, by array<double>"
    rows = sorted(sample.select("doc_id", "text", "y").mapInArrow(run, kinds).collect(), key=lambda r: r.doc_id)
    y = np.array([float(r.y > 0) for r in rows])
    if not len(y) or y.min() == y.max() or not chosen:
        share = min(0.99, max(0.01, y.mean())) if len(y) else 0.5
        return Model({}, np.zeros(0), math.log(share / (1 - share)))

    def flat(pairs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and scaled value of every entry."""
        at = np.repeat(np.arange(len(pairs)), [len(f) for f, _ in pairs])
        col = np.array([i for f, _ in pairs for i in f], np.int64)
        return at, col, np.array([v for _, values in pairs for v in values], float) * scale[col]

    scale = np.array(list(chosen.values()))
    data = flat([(r.f, np.log1p(r.n)) for r in rows])
    change = flat([(r.changed, r.by) for r in rows])
    weights, bias = _descend(data, y, change, len(chosen), penalty)
    return Model(empty.features, weights * scale, bias)


def _descend(data, y, change, width, penalty) -> tuple[np.ndarray, float]:
    """Minimises the mean log loss, the mean squared change by swapping and the square of the weights (Adam, whole sample)."""
    at, col, val = data
    rows, cols, diff = change
    w, b = np.zeros(width), math.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for step in range(1, STEPS + 1):
        z = b + np.bincount(at, val * w[col], len(y))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.append(np.bincount(col, val * g[at], width) + L2 * w / 10, g.sum())
        dz = np.bincount(rows, diff * w[cols], len(y))
        grad[:width] += 2 * penalty * np.bincount(cols, diff * dz[rows], width) / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:width], b - move[width]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", most: int = MAX_TRAIN) -> Model:
    """Fits on at most ``most`` labelled documents whose ``doc_id`` is ``usable``."""
    return fit(labelled_sample(docs, labels, label, most, usable))


def score(docs: DataFrame, model: Model) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct with ``score`` between 0 and 1 from the text alone; its name is returned too.

    Null and empty texts get the score of a text without known words. Whole texts of any length are read.
    """
    get = shared(docs.sparkSession, model)
    cache: dict[bytes, tuple[int, ...]] = {}

    def scores(texts: list[bytes]) -> list[list]:
        model = get()
        return [[model.score(t, cache) for t in texts]]

    return with_struct(docs, "text", "struct<score: double>", scores)
