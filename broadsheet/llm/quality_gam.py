"""Quality by a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn, one feature at a time, and summed into one look-up table per feature; then trees over
the pairs that still explain most. A text is scored by adding the table entries of its bins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from broadsheet.llm.quality_rules import base_figures
from broadsheet.llm.rows import as_bytes, shared, slices, with_struct
from broadsheet.llm.samples import labelled_sample

MAX_TRAIN = 20_000  # labelled documents that the model is fitted on, at the utmost
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 4
RATE = 0.1
LEAST_IN_LEAF = 10
THRESHOLD = 0.3

FEATURES = [
    "log_words", "word_length", "symbols", "pipes", "upper", "bangs", "points", "digits", "beyond_ascii", "distinct", "commonest",
    "repeated", "repeated_lines", "line_words",
]
_UPPER, _DIGITS, _POINTS = bytes(range(65, 91)), b"0123456789", b".,;:?"
_BEYOND = bytes(range(0xC0, 0x100))


def figures(text: bytes) -> list[float]:
    """The values of ``FEATURES``; an empty text has zeros."""
    n, chars, symbols, dup, repeated = base_figures(text)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    share = lambda those: (size - len(text.translate(None, those))) / size
    counts = Counter(text.lower().split())
    lines = sum(1 for x in text.split(b"\n") if x.strip())
    return [
        np.log1p(n), chars / n, symbols / size, text.count(b"|") / n, share(_UPPER), text.count(b"!") / n, share(_POINTS), share(_DIGITS),
        share(_BEYOND), len(counts) / n, max(counts.values()) / n, repeated / n, dup / lines, n / lines,
    ]


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; 0 and -1 without one."""
    if len(g) < 2:
        return 0.0, -1
    cg, ch, cn = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    left, right = cg**2 / (ch + 1), (g.sum() - cg) ** 2 / (h.sum() - ch + 1)
    gain = left + right - g.sum() ** 2 / (h.sum() + 1)
    gain[(cn < LEAST_IN_LEAF) | (n.sum() - cn < LEAST_IN_LEAF)] = 0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, -1)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of each bin of a shallow tree on one feature, from sums of gradients, curvatures and rows."""
    _, at = _best_cut(g, h, n) if depth else (0.0, -1)
    if at < 0:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], n[:at], depth - 1), _tree(g[at:], h[at:], n[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree that cuts the first feature once and the second one on either side, or the reverse."""
    best, values = 0.0, np.zeros_like(g)
    for turned in (False, True):
        a, b, c = (x.T for x in (g, h, n)) if turned else (g, h, n)
        for at in range(1, len(a)):
            gain, out = 0.0, np.zeros_like(a)
            for part in (slice(0, at), slice(at, None)):
                x, y, z = a[part].sum(0), b[part].sum(0), c[part].sum(0)
                more, _ = _best_cut(x, y, z)
                gain += more + x.sum() ** 2 / (y.sum() + 1)
                out[part] = _tree(x, y, z, 1)
            gain -= a.sum() ** 2 / (b.sum() + 1)
            if gain > best + 1e-9:
                best, values = gain, out.T if turned else out
    return best, values


@dataclass
class Additive:
    bias: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (a, b), table in self.pairs.items():
            z += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def boost(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fits tables to rows of figures and labels 0 or 1. One class only: its share, kept off 0 and 1, for every text."""
    share = min(0.99, max(0.01, float(y.mean()))) if len(y) else 0.5
    model = Additive(bias=float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    width = x.shape[1]
    model.edges = [_edges(x[:, f], BINS) for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    z = np.full(len(y), model.bias)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            g, h = slope()
            k = len(model.tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, k), np.bincount(bins[f], h, k), np.bincount(bins[f], minlength=k))
            model.tables[f] += step
            z += step[bins[f]]
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(width)]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.pair_edges)]
    size = [len(e) + 1 for e in model.pair_edges]

    def sums(a: int, b: int, values: np.ndarray | None) -> np.ndarray:
        return np.bincount(coarse[a] * size[b] + coarse[b], values, size[a] * size[b]).reshape(size[a], size[b])

    g, h = slope()
    gains = {(a, b): _pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, None))[0] for a, b in combinations(range(width), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pairs = {p: np.zeros((size[p[0]], size[p[1]])) for p in chosen if gains[p] > 0}
    for _ in range(PAIR_ROUNDS):
        for a, b in model.pairs:
            g, h = slope()
            step = RATE * _pair_tree(sums(a, b, g), sums(a, b, h), sums(a, b, None))[1]
            model.pairs[a, b] += step
            z += step[coarse[a], coarse[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", most: int = MAX_TRAIN) -> Additive:
    """Fits on at most ``most`` labelled documents whose ``doc_id`` is ``usable``; the driver gets their figures only."""
    sample = labelled_sample(docs, labels, label, most, usable)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            x = [figures(t) for t in as_bytes(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = sorted(sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id bigint, y int, x array<double>").collect(), key=lambda r: r.doc_id)
    return boost(np.array([r.x for r in rows]).reshape(len(rows), len(FEATURES)), np.array([float(r.y > 0) for r in rows]))


def score(docs: DataFrame, model: Additive) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct with ``score`` between 0 and 1 from the text alone; its name is returned too.

    Null counts as empty; an empty text is scored by figures of zero.
    """
    get = shared(docs.sparkSession, model)

    def scores(texts: list[bytes]) -> list[list]:
        return [get().scores(np.array([figures(t) for t in texts]).reshape(len(texts), len(FEATURES))).tolist()]

    return with_struct(docs, "text", "struct<score: double>", scores)
