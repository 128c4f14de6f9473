"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is the set of its windows, and a window the set of its word shingles. A document contains a window only
if it contains all its shingles, so the rarest one, counted over all documents, is a prefix that every match must share.
Documents are joined with the windows on that shingle; where the window would begin (its position) and end (its length)
must lie inside the document, and what is left is compared word by word.

The documents are never shuffled: the benchmark is a stated query set that goes to the tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.rows import as_bytes, shared, slices, with_struct
from broadsheet.session import durable

WINDOW = 13
SHINGLE = 3
BLOCK_WORDS = 1_000_000  # words of the benchmark per block: what a task holds of it
PAIRS_AT_ONCE = 1 << 18
RATIO = 20

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and all characters beyond ASCII."""
    return text.translate(_WORD).split()


class Windows:
    """The windows of one block of items, with numbered words and the postings of their prefix shingles."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW, shingle: int = SHINGLE):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1) if ids else ():
                owners[tuple(ids[at : at + size])].add(item)
        self.windows = list(owners)
        self.items = [sorted(x, key=lambda i: (i is None, i or 0)) for x in owners.values()]
        self.base = len(self.vocabulary) + 1
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.shingle = shingle
        width = max(self.lengths, default=0)
        self.words = np.zeros((len(self.windows), width), np.int32)
        for i, w in enumerate(self.windows):
            self.words[i, : len(w)] = w
        self.keys: dict[int, np.ndarray] = {}
        for k in range(1, shingle + 1):
            rows = np.flatnonzero(np.minimum(self.lengths, shingle) == k)
            if len(rows):
                keys = [self.shingle_keys(self.words[r, : self.lengths[r]].astype(np.int64), k) for r in rows]
                self.keys[k] = np.unique(np.concatenate(keys))
        self.postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def shingle_keys(self, ids: np.ndarray, k: int) -> np.ndarray:
        out = ids[: len(ids) - k + 1].copy()
        for j in range(1, k):
            out = out * self.base + ids[j : len(ids) - k + 1 + j]
        return out

    def number(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all texts with a 0 after each (0 also stands for words that no item has), and where each
        text begins and ends."""
        ids: list[int] = []
        starts, ends = [], []
        get = self.vocabulary.get
        for text in texts:
            starts.append(len(ids))
            ids.extend([get(w, 0) for w in words_of(text)])
            ends.append(len(ids))
            ids.append(0)
        return np.array(ids, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)

    def places(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Positions where k words in a row are all known."""
        known = ids > 0
        ok = known[: max(0, len(ids) - k + 1)].copy()
        for j in range(1, k):
            ok &= known[j : len(ids) - k + 1 + j]
        return np.flatnonzero(ok)

    def keys_at(self, ids: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
        out = ids[places]
        for j in range(1, k):
            out = out * self.base + ids[places + j]
        return out

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keeps for each window the place of its rarest shingle, the leftmost of equals."""
        for k, keys in self.keys.items():
            rows = np.flatnonzero(np.minimum(self.lengths, self.shingle) == k)
            found, at = [], []
            for r in rows:
                own = self.shingle_keys(self.words[r, : self.lengths[r]].astype(np.int64), k)
                best = int(np.argmin(counts[k][np.searchsorted(keys, own)]))
                found.append(own[best])
                at.append(best)
            order = np.argsort(found, kind="stable")
            self.postings[k] = np.array(found)[order], np.array(at, np.int64)[order], rows[order]

    def match(self, texts: list[bytes]) -> list[list]:
        """Per text: number of words, hit words, and the items with an occurring window."""
        starts, ends, owner, covered, items = self.search(texts)
        n_hit = np.bincount(owner[covered], minlength=len(texts))
        return [(ends - starts).tolist(), n_hit.tolist(), items]

    def hits(self, texts: list[bytes]) -> list[list]:
        """Per text: the places of its hit words, and the items with an occurring window."""
        starts, ends, _, covered, items = self.search(texts)
        places = [np.flatnonzero(covered[a:b]).tolist() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        return [places, items]

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list]]:
        ids, starts, ends = self.number(texts)
        owner = np.repeat(np.arange(len(texts)), ends - starts + 1)
        steps = np.zeros(len(ids) + 1, np.int64)
        found: list[set] = [set() for _ in texts]
        for k, (keys, offsets, rows) in self.postings.items():
            places = self.places(ids, k)
            wanted = self.keys_at(ids, places, k)
            low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
            hit = np.flatnonzero(high > low)
            places, low, many = places[hit], low[hit], (high - low)[hit]
            at = 0
            while at < len(places):
                upto = at + max(1, int(np.searchsorted(np.cumsum(many[at:]), PAIRS_AT_ONCE, "right")))
                n = many[at:upto]
                first = np.repeat(np.cumsum(n) - n, n)
                post = np.repeat(low[at:upto], n) + np.arange(n.sum()) - first
                place = np.repeat(places[at:upto], n)
                self._verify(ids, starts, ends, owner, place - offsets[post], rows[post], place, steps, found)
                at = upto
        covered = np.cumsum(steps[:-1]) > 0
        items = [sorted({i for w in ws for i in self.items[w]}, key=lambda i: (i is None, i or 0)) for ws in found]
        return starts, ends, owner, covered, items

    def _verify(self, ids, starts, ends, owner, begin, window, place, steps, found) -> None:
        length, doc = self.lengths[window], owner[place]
        inside = (begin >= starts[doc]) & (begin + length <= ends[doc])
        begin, window, length, doc = begin[inside], window[inside], length[inside], doc[inside]
        for size in np.unique(length):
            of = length == size
            b, w, d = begin[of], window[of], doc[of]
            same = (ids[b[:, None] + np.arange(size)] == self.words[w, :size]).all(axis=1)
            b, w, d = b[same], w[same], d[same]
            np.add.at(steps, b, 1)
            np.add.at(steps, b + size, -1)
            for one, win in {(x, y) for x, y in zip(d.tolist(), w.tolist(), strict=True)}:
                found[one].add(win)


def _shingle_counts(docs: DataFrame, block: Windows) -> dict[int, np.ndarray]:
    """Occurrences over all documents of each shingle of the block."""
    get = shared(docs.sparkSession, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = get()
        total = {k: np.zeros(len(keys), np.int64) for k, keys in windows.keys.items()}
        for piece in slices(batches):
            ids, _, _ = windows.number(as_bytes(piece.column(0)))
            for k, keys in windows.keys.items():
                own = windows.keys_at(ids, windows.places(ids, k), k)
                at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                total[k] += np.bincount(at[keys[at] == own], minlength=len(keys))
        for k, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["k", "at", "n"]
            )

    out = {k: np.zeros(len(keys), np.int64) for k, keys in block.keys.items()}
    counted = docs.select("text").mapInArrow(run, "k int, at bigint, n bigint").groupBy("k", "at").agg(F.sum("n").alias("n"))
    for r in counted.toLocalIterator():  # no more rows than the block has shingles
        out[r.k][r["at"]] = r.n
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS, ratio: int = RATIO
) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct ``(n_words, n_hit, items, contaminated)``; its name is returned too.

    A word is hit if it lies in an occurrence of a window: ``window`` consecutive words of an item, or the whole item if it
    has fewer (none: no window). ``contaminated``: some word is hit, and at least one in ``ratio`` words. Null texts have
    no words. Repeated items and repeated rows count as they are; items of equal text are all reported; null item ids too.
    A benchmark of more than ``block_words`` words is matched block by block, and hits of a word in several blocks count once.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * block_words)))
    fields = "struct<n_words: bigint, n_hit: bigint, items: array<bigint>>"
    if blocks == 1:
        out, name = _one_block(docs, items, window, shingle, fields)
    else:
        return _many_blocks(docs, items, blocks, window, shingle, ratio)
    found = F.col(name)
    bad = (found["n_hit"] > 0) & (ratio * found["n_hit"] >= found["n_words"])
    return out.withColumn(name, found.withField("contaminated", bad)), name


def _windows(items: DataFrame, window: int, shingle: int) -> Windows:
    rows = [(r.item_id, (r.text or "").encode()) for r in items.toLocalIterator()]  # one block
    return Windows(rows, window, shingle)


def _one_block(docs: DataFrame, items: DataFrame, window: int, shingle: int, fields: str) -> tuple[DataFrame, str]:
    windows = _windows(items, window, shingle)
    windows.choose(_shingle_counts(docs, windows))
    get = shared(docs.sparkSession, windows)
    return with_struct(docs, "text", fields, lambda texts: get().match(texts))


def _many_blocks(docs, items, blocks, window, shingle, ratio) -> tuple[DataFrame, str]:
    """The hit places of each block are joined into those of the blocks before, one stored pass per block."""
    out, name = with_struct(docs, "text", "struct<places: array<bigint>, items: array<bigint>>", lambda t: [[[]] * len(t), [[]] * len(t)])
    for block in range(blocks):
        windows = _windows(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block), window, shingle)
        windows.choose(_shingle_counts(docs, windows))

        def hits(texts: list[bytes], get=shared(docs.sparkSession, windows)) -> list[list]:
            return get().hits(texts)

        more, extra = with_struct(out, "text", "struct<places: array<bigint>, items: array<bigint>>", hits, "more")
        merged = F.struct(
            F.array_union(F.col(name)["places"], F.col(extra)["places"]).alias("places"),
            F.array_union(F.col(name)["items"], F.col(extra)["items"]).alias("items"),
        )
        out = durable(more.withColumn(name, merged).drop(extra))
    counted, words = with_struct(out, "text", "struct<n: bigint>", lambda t: [[len(words_of(x)) for x in t]], "words")
    n, n_hit = F.col(words)["n"], F.size(F.col(name)["places"]).cast("bigint")
    done = F.struct(
        n.alias("n_words"), n_hit.alias("n_hit"), F.sort_array(F.col(name)["items"]).alias("items"),
        ((n_hit > 0) & (ratio * n_hit >= n)).alias("contaminated"),
    )
    return counted.withColumn(name, done).drop(words), name
