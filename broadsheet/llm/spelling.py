"""Groups spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, which turns every word into a reduced word. Words one edit apart have reduced words at
most one edit apart, so each word generates the full neighbourhood of its reduced word (itself, every deletion, replacement
and insertion of one symbol; the alphabet has few, so these are few) and meets the words with these reduced words. What
meets is verified on the original strings. Reduced words travel as 64-bit polynomial hashes, from which those of all
neighbours follow by a few products; hashes that agree by chance do not survive the verification.

Most neighbours are no word's reduced word. A bitmap of fixed size, with a bit for each reduced word that occurs, is sent to
the tasks and drops these where they are made. It is built by Spark, and loses nothing: a full one would only drop less.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.rows import as_bytes, shared, slices
from broadsheet.session import durable, numbered

LETTERS = "a-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
SYMBOLS = 8
SLOT_BITS = 27
BLOCK_BITS = 16
HELD_WORDS = 1 << 17
KEYS_AT_ONCE = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_SPREAD = 0xD6E8FEB86659FD93


def word_counts(
    docs: DataFrame, text: str = "text", id_: str | None = None, rewrite: Callable[[str, str], str] | None = None,
    least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)``: maximal runs of letters in all texts, A-Z lower-cased, and how often they occur.

    Words of fewer letters or occurrences are left out. ``rewrite(id, word)`` may change a run before it is counted, which must
    not make it longer. Null and empty texts have no words, a null id is an empty string. Counts of a task are added up before
    the shuffle, so that a frequent word is one row a task.
    """
    find = re.compile(f"[{LETTERS}]{{{least_letters},}}").findall
    rows = docs.select((F.col(id_).cast("string") if id_ else F.lit("")).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for piece in slices(batches):
            for name, raw in zip(piece.column(0).to_pylist(), as_bytes(piece.column(1)), strict=True):
                own: dict[str, int] = {}
                for w in find(raw.lower().decode("utf-8", "replace")):  # bytes: only A-Z change
                    own[w] = own.get(w, 0) + 1
                for w, n in own.items():
                    if rewrite:
                        w = rewrite(name or "", w)
                        if len(w) < least_letters:
                            continue
                    total[w] = total.get(w, 0) + n
                if len(total) > HELD_WORDS:
                    yield flush()
                    total.clear()
        yield flush()

    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def reduced(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """Symbols 1 to ``symbols`` of words of one length, a row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    mixed = (points * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(symbols)) >> np.uint64(32)).reshape(len(words), -1) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def keys(letters: np.ndarray) -> np.ndarray:
    """Hash of each reduced word."""
    return (letters * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbour_keys(letters: np.ndarray, symbols: int = SYMBOLS) -> Iterator[np.ndarray]:
    """Hashes of the whole one-edit neighbourhood of each reduced word, the word itself included; a row a word.

    They come in pieces of some places of the words each, so that a long word is not held with all its neighbours.
    """
    n, width = letters.shape
    power = _powers(width + 1)
    before = np.zeros((n, width + 1), np.uint64)
    np.cumsum(letters * power[:-1], axis=1, dtype=np.uint64, out=before[:, 1:])
    whole = before[:, -1:]
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    base, unbase = np.uint64(_BASE), np.uint64(_UNBASE)
    step = max(1, KEYS_AT_ONCE // (2 * n * symbols))
    yield whole
    for a in range(0, width + 1, step):
        b = min(a + step, width + 1)
        inserted = (before[:, a:b] + (whole - before[:, a:b]) * base)[:, :, None] + (every * power[a:b, None])[None]
        b = min(b, width)
        deleted = before[:, a:b] + (whole - before[:, a + 1 : b + 1]) * unbase
        replaced = whole[:, :, None] + (every - letters[:, a:b, None]) * power[a:b, None]
        yield np.concatenate([deleted, inserted.reshape(n, -1), replaced.reshape(n, -1)], axis=1)


def slots(keys_: np.ndarray) -> np.ndarray:
    return ((keys_ * np.uint64(_SPREAD)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and symbols of words of one length, few enough to be handled together."""
    size = np.array([len(w) for w in words])
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        step = max(1, KEYS_AT_ONCE // (2 * symbols * (int(length) + 1)))
        for a in range(0, len(at), step):
            yield at[a : a + step], reduced([words[i] for i in at[a : a + step]], symbols)


def _with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """Adds the hash of the reduced word and its bit in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.uint64)
            for at, letters in _by_length(batch.column(0).to_pylist(), symbols):
                found[at] = keys(letters)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64)), pa.array(slots(found))], names=["word", "n", "key", "slot"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint, slot bigint")


def _bitmap(words: DataFrame) -> np.ndarray:
    """The bits of all ``slot`` values: built in blocks by the tasks; the whole has ``2 ** SLOT_BITS`` bits."""
    width = 1 << BLOCK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy()
            for block in np.unique(slot >> BLOCK_BITS).tolist():
                own.setdefault(block, np.zeros(width, bool))[slot[slot >> BLOCK_BITS == block] & (width - 1)] = True
        bits = [np.packbits(b, bitorder="little").tobytes() for b in own.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64()), pa.array(bits, pa.binary())], names=["block", "bits"])

    dealt = words.select("slot").distinct().repartition(F.shiftright("slot", BLOCK_BITS))
    whole = np.zeros((1 << SLOT_BITS) // width * width // 8, np.uint8)
    for r in dealt.mapInArrow(run, "block bigint, bits binary").toLocalIterator():
        whole[r.block * width // 8 : (r.block + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return whole


def _neighbourhoods(words: DataFrame, symbols: int) -> DataFrame:
    """``(id, key)``: for every word the hashes of its reduced neighbourhood that may be reduced words."""
    get = shared(words.sparkSession, _bitmap(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = get()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, letters in _by_length(batch.column(1).to_pylist(), symbols):
                kept = []
                for found in neighbour_keys(letters, symbols):
                    slot = slots(found)
                    row, col = np.nonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    kept.append(np.rec.fromarrays([at[row], found[row, col]], names="row,key"))
                pairs = np.unique(np.concatenate(kept))
                yield pa.RecordBatch.from_arrays([pa.array(ids[pairs["row"]]), pa.array(pairs["key"].view(np.int64))], names=["id", "key"])

    return words.select("id", "word").mapInArrow(run, "id bigint, key bigint")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``(id, other, other_word, other_n, n)``: all ordered pairs of words exactly one edit of one code point apart.

    ``words(id, word, n, key, slot)`` has every word once.
    """
    others = words.select("key", F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    met = _neighbourhoods(words, symbols).join(others, "key").where("id <> other").drop("key")
    both = met.join(words.select("id", "word", "n"), "id")
    return both.where(F.levenshtein("word", "other_word", 1) == 1).drop("word")


def _roots(links: DataFrame) -> DataFrame:
    """``(id, root)``: where the links ``(id, root)`` end. Each round doubles the steps taken, and counts rise along links by a
    factor, so that the rounds are few."""
    now = durable(links)
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = durable(now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.where("moved").head(1):
            return now.drop("moved")
        now = now.drop("moved")


def variants(counts: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``(word, n, form, form_n, n_near, root)`` for every row of ``counts(word, n)``, whose words are different.

    ``form`` is the near word of the largest ``n`` (ties: the smallest by code points) if it is at least ``ratio`` times as
    frequent, else null; ``root`` is where forms lead, the word itself without one. ``n_near`` counts the words one edit away.
    Null words are dropped; the empty word has neighbours of one letter. An empty table gives an empty result.
    """
    words = numbered(_with_keys(counts.where("word IS NOT NULL"), symbols), "id")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other_word").alias("form"), F.col("other").alias("form_id"))).alias("best")
    stats = near_words(words, symbols).groupBy("id").agg(F.count("*").alias("n_near"), best, F.first("n").alias("own"))
    kept = -F.col("best.less") >= ratio * F.col("own")
    stats = durable(stats.select("id", "n_near", *[F.when(kept, c).alias(a) for c, a in ((F.col("best.form"), "form"), (F.col("best.form_id"), "form_id"), (-F.col("best.less"), "form_n"))]))
    roots = _roots(stats.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root")))
    spelt = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    out = words.select("id", "word", "n").join(stats, "id", "left").join(spelt, "id", "left")
    return out.select("word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.coalesce("root_word", "word").alias("root"))
