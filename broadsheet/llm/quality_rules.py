"""Quality rules: figures of each text, and lines that too many documents of one host repeat.

Lines are normalised and hashed; the distinct documents that hold a line are counted per host. A second pass takes the
lines above the limit out of the texts; documents that lose most of their words that way are rejected. Few such lines go to
the tasks as a table, so that no text is shuffled; more than ``TABLE_LINES`` are joined with the rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.rows import as_bytes, fresh_name, join_on_counted, slices
from broadsheet.session import durable, numbered

SYMBOLS = b"#*$%&|<>"  # fixed values: the characters that count as symbols
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows
WINDOW = 3
LEAST_DOCUMENTS = 20  # a line of fewer documents of a host is never above the limit
SHARE = 0.01  # of the host's documents
LEAST_LEFT = 0.3  # of a document's words
TABLE_LINES = 100_000  # so many lines above the limit go to every task
LINE = ["host", "h1", "h2"]
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words"]


def base_figures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in windows that occur twice or more."""
    words = text.split()  # ASCII white space
    chars = sum(map(len, words)) - (len(text) - len(text.translate(None, _CONTINUED)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = len(words)
    covered = 0
    if n >= WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            last = 0
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    covered += i + WINDOW - max(i, last)
                    last = i + WINDOW
    return n, chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), covered


#: Bytes that continue a code point.
_CONTINUED = bytes(range(0x80, 0xC0))


def line_key(words: list[bytes]) -> tuple[int, int]:
    """The hash of a normalised line: single blanks, A-Z lower-cased."""
    d = hashlib.blake2b(b" ".join(words).lower(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def without_lines(text: bytes, keys: set[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the lines of these hashes, and the words that went with them."""
    kept, gone = [], 0
    for line in text.split(b"\n"):
        words = line.split()
        if words and line_key(words) in keys:
            gone += len(words)
        else:
            kept.append(line)
    return b"\n".join(kept), gone


def _host_key(host: str) -> Column:
    """Never null: a null host is a host of its own."""
    return F.when(F.col(host).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(host)))


def _lines(rows: DataFrame, key: str) -> DataFrame:
    """``(key, host, h1, h2)``: the distinct lines of each row of ``(key, host, text)``."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            at, found = [], []
            for i, text in enumerate(as_bytes(piece.column(2))):
                keys = {line_key(w) for w in map(bytes.split, text.split(b"\n")) if w}
                at += [i] * len(keys)
                found += keys
            hashes = [pa.array([k[i] for k in found], pa.int64()) for i in range(2)]
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0).take(at), piece.column(1).take(at), *hashes], names=[key, *LINE])

    return rows.select(key, "host", "text").mapInArrow(run, f"`{key}` {kind}, host string, h1 bigint, h2 bigint")


def _rewrite(rows: DataFrame, columns: list[str], drops: Callable[[pa.RecordBatch], list], name: str) -> DataFrame:
    """``columns`` of ``rows``, without the lines that ``drops`` names for each row of a slice, and the struct ``name``."""
    fields = [rows.schema[c] for c in columns]
    schema = T.StructType([*fields, T.StructField(name, T.StructType([T.StructField(f, T.LongType()) for f in FIGURES]))])
    at, names = columns.index("text"), [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            whole = piece.column(at).cast(pa.binary()).to_pylist()
            texts, figures = [], []
            for text, keys in zip(whole, drops(piece), strict=True):
                left, gone = without_lines(text, keys) if text and keys else (text, 0)
                texts.append(left)
                figures.append((*base_figures(text or b""), gone))
            arrays = [pa.array([f[i] for f in figures], pa.int64()) for i in range(len(FIGURES))]
            out = piece.columns[: len(columns)]
            out[at] = pa.array(texts, pa.binary()).cast(piece.column(at).type)
            yield pa.RecordBatch.from_arrays([*out, pa.StructArray.from_arrays(arrays, FIGURES)], names=names)

    return rows.mapInArrow(run, schema)


def clean(
    docs: DataFrame, host: str = "source", least_documents: int = LEAST_DOCUMENTS, share: float = SHARE, least_left: float = LEAST_LEFT,
    table_lines: int = TABLE_LINES,
) -> tuple[DataFrame, str]:
    """All columns of ``docs`` with the lines above the limit taken out of ``text``, and one struct column
    ``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_line_words, base_failed, kept)``, whose name is returned.

    A line is above the limit when at least ``least_documents`` documents of the host hold it and they are more than
    ``share`` of the host's documents. ``n_line_words`` counts the words taken out with such lines, all other figures are
    those of the text before; a document that keeps less than ``least_left`` of its words is rejected. Null text has no
    words, fails, and stays null. A null host is a host of its own; rows of one id count as one document, rows without id as
    one. One result row per row, rejected ones included.
    """
    keyed = docs.select("doc_id", _host_key(host).alias("host"), "text")
    sizes = keyed.select("host", "doc_id").distinct().groupBy("host").agg(F.count("*").alias("n_host"))
    held = _lines(keyed, "doc_id").groupBy(*LINE, "doc_id").agg(F.count("*").alias("n"))
    counted = held.groupBy(*LINE).agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_rows")).where(F.col("n_docs") >= least_documents)
    above = durable(counted.join(sizes, "host").where(F.col("n_docs") > share * F.col("n_host")).select(*LINE, "n_rows"))
    name, row, at = fresh_name(docs.columns, "found"), fresh_name(docs.columns, "row"), len(docs.columns)
    few = above.limit(table_lines + 1).collect()
    if len(few) <= table_lines:
        table: dict[str, set[tuple[int, int]]] = {}
        for x in few:
            table.setdefault(x.host, set()).add((x.h1, x.h2))
        rows = docs.withColumn(row, _host_key(host))

        def drops(piece: pa.RecordBatch) -> list:
            return [table.get(h) for h in piece.column(at).to_pylist()]
    else:
        rows = numbered(docs, row)
        lines = _lines(rows.select(row, _host_key(host).alias("host"), "text"), row)
        found = join_on_counted(lines, above, LINE, "n_rows").groupBy(row).agg(F.collect_list(F.struct("h1", "h2")).alias(name))
        rows = rows.join(found, row, "left").select(*docs.columns, name)

        def drops(piece: pa.RecordBatch) -> list:
            return [x and {(k["h1"], k["h2"]) for k in x} for x in piece.column(at).to_pylist()]

    out, x = _rewrite(rows, docs.columns, drops, name), F.col(name)
    failed = (x["n_words"] < MIN_WORDS) | (100 * x["n_repeat_words"] > MAX_REPEATED * x["n_words"])
    depleted = x["n_words"] - x["n_line_words"] < least_left * x["n_words"]
    return out.withColumn(name, F.struct(*[x[f].alias(f) for f in FIGURES], failed.alias("base_failed"), (~failed & ~depleted).alias("kept"))), name


def judge(
    docs: DataFrame, host: str = "source", least_documents: int = LEAST_DOCUMENTS, share: float = SHARE, least_left: float = LEAST_LEFT
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_line_words, kept)`` of ``clean``."""
    out, name = clean(docs.select("doc_id", F.col(host).alias("host"), "text"), "host", least_documents, share, least_left)
    return out.select("doc_id", *[F.col(name)[f].alias(f) for f in (*FIGURES[:-1], "base_failed", "n_line_words", "kept")])
