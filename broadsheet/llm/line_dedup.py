"""Line dedup over levelled sorted runs of line hashes.

Documents arrive in batches. A batch's line keys are merge-anti-joined with the runs: keys that no run has become a new
run of their own, all others are noted as sightings. Runs of one level are merged into one of the next level when there
are enough of them, so that a batch meets few runs. A key is in one run only; its first holder and its sightings together
give the number of documents that hold it.

Runs are tables bucketed and sorted by key, below the shared folder. A batch is shuffled by key once, into the same buckets;
from then on joins, merges of runs and the writing of new ones go on bucket by bucket, and no run is shuffled or sorted.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.rows import as_bytes, fresh_name, join_on_counted, slices
from broadsheet.session import durable, scratch_path

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FAN_OUT = 2
KEY = ["h1", "h2"]


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte hash of a line without outer ASCII white space, A-Z lower-cased; None when it is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def document_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(batch, h1, h2, doc_id)``: the distinct line keys of each row, with the batch that the document comes in."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(parts):
            ids, hashes = [], []
            for doc, batch, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), as_bytes(piece.column(2)), strict=True):
                found = {h for h in (line_key(x, min_chars) for x in text.split(b"\n")) if h is not None}
                ids += [(batch, doc)] * len(found)
                hashes += found
            flat = [int.from_bytes(h[:8], "little", signed=True) for h in hashes], [int.from_bytes(h[8:], "little", signed=True) for h in hashes]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in ids], pa.int32()), *(pa.array(x, pa.int64()) for x in flat), pa.array([x[1] for x in ids], pa.int64())],
                names=["batch", "h1", "h2", "doc_id"],
            )

    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    return docs.select("doc_id", batch, "text").mapInArrow(run, "batch int, h1 bigint, h2 bigint, doc_id bigint")


class Runs:
    """Sorted runs by level, and the tables of all batches, whose known keys are sightings."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.seen: list[DataFrame] = []
        self.names: list[str] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a table bucketed and sorted by key. They come in the buckets' own partitions, so that each bucket is one file."""
        name = f"run_{uuid.uuid4().hex}"
        sorted_scans = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(sorted_scans)
        self.spark.conf.set(sorted_scans, "true")  # the one file of a bucket is read in its order
        try:
            rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet").option("path", scratch_path(self.spark, name)).saveAsTable(name)
        finally:
            self.spark.conf.set(sorted_scans, before)
        self.names.append(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> None:
        """Adds one batch of ``(h1, h2, doc_id)`` rows."""
        keys = lines.distinct().groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        known = F.lit(False)
        for i, run in enumerate(r for level in self.levels for r in level):
            keys = keys.join(run.select(*KEY, F.lit(True).alias(f"in_{i}")).hint("merge"), KEY, "left")
            known = known | F.col(f"in_{i}").isNotNull()
        batch = self._write(keys.select(*KEY, "n", "last", known.alias("known")))
        self.seen.append(batch.where("known").drop("known"))
        self._push(0, batch.where("NOT known").drop("known"))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_out:
            merged, *others = self.levels[level]
            for other in others:  # no key is in both: a merge of the sorted rows
                right = other.select(*KEY, F.col("n").alias("n_"), F.col("last").alias("last_"))
                merged = merged.join(right.hint("merge"), KEY, "full").select(*KEY, F.coalesce("n", "n_").alias("n"), F.coalesce("last", "last_").alias("last"))
            self.levels[level] = []
            self._push(level + 1, self._write(merged))

    def totals(self) -> DataFrame:
        """``(h1, h2, n, last)``: documents that hold a key and the largest id among them."""
        parts = [run for level in self.levels for run in level] + self.seen
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def forget(self) -> None:
        """Takes the tables out of the session's catalogue; their files stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")
        self.names = []


def dedup_lines(
    docs: DataFrame, batches: int = BATCHES, fan_out: int = FAN_OUT, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """All columns of ``docs`` with the kept lines as ``text``, and ``n_lines``, ``n_dropped`` (lengthened by ``_`` if taken).

    Lines whose key is in at least ``min_documents`` documents stay only in the document of the largest id. Null text is
    one empty line and comes back empty. Rows of the same id are one document; null is an id below all others. A line
    that is repeated inside its document is dropped or kept as often as it occurs. ``doc_id`` has to be a whole number.
    """
    spark = docs.sparkSession
    lines = document_lines(docs, batches, min_chars)
    path = scratch_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    stored = spark.read.schema("h1 bigint, h2 bigint, doc_id bigint, batch int").parquet(path)
    runs = Runs(spark, fan_out)
    for batch in range(batches):
        runs.add(stored.where(F.col("batch") == batch).select(*KEY, "doc_id"))
    frequent = durable(runs.totals().where(F.col("n") >= min_documents))
    runs.forget()
    repeated = join_on_counted(stored.select(*KEY, "doc_id"), frequent, KEY, "n").where(
        ~F.col("doc_id").eqNullSafe(F.col("last"))
    )
    drops = repeated.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("drop"))
    return _rewrite(docs, drops, min_chars)


def _rewrite(docs: DataFrame, drops: DataFrame, min_chars: int) -> DataFrame:
    id_, drop = fresh_name(docs.columns, "drop_id"), fresh_name(docs.columns, "drop")
    joined = docs.join(drops.select(F.col("doc_id").alias(id_), F.col("drop").alias(drop)), docs["doc_id"].eqNullSafe(F.col(id_)), "left").drop(id_)
    n_lines = fresh_name(docs.columns, "n_lines")
    n_dropped = fresh_name([*docs.columns, n_lines], "n_dropped")
    fields = [*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())]
    at, names = docs.columns.index("text"), [f.name for f in fields]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(parts):
            texts, counts, gone = [], [], []
            for text, found in zip(as_bytes(piece.column(at)), piece.column(len(names) - 2).to_pylist(), strict=True):
                lines = text.split(b"\n")
                kept = lines
                if found:
                    bad = {x["h1"].to_bytes(8, "little", signed=True) + x["h2"].to_bytes(8, "little", signed=True) for x in found}
                    kept = [x for x in lines if line_key(x, min_chars) not in bad]
                texts.append(b"\n".join(kept))
                counts.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = piece.columns[: len(names) - 2]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], names=names)

    return joined.mapInArrow(run, T.StructType(fields))
