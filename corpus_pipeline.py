"""From raw documents to a mix for training: five stages, each an operator of ``broadsheet.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its result is written as Parquet and
read again. All but the last return the columns of ``documents``; the last returns what the mix takes of each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontaminate, jaccard_join, line_dedup, mixing, toxicity
from broadsheet.llm.samples import fold
from broadsheet.session import durable, numbered

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scored, name = toxicity.score(docs, model)
    return scored.where(F.col(name)["score"] < toxicity.THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines that it keeps, and the length of what is left."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that of the smallest id, rows without id last; ids may repeat. Without words, rows of one id
    and text stay once and rows without id all stay."""
    rows = numbered(docs.select(*COLUMNS), "_row")
    worded = F.coalesce("text", F.lit("")).rlike(r"[^ \t-\r]")
    groups = jaccard_join.similar_components(rows.where(worded).select(F.col("_row").alias("doc_id"), "text"))
    members = groups.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("x"))
    chosen = rows.join(first.select("x._row"), "_row", "left_semi").select(*COLUMNS)
    blank = rows.where(~worded).select(*COLUMNS)
    return chosen.unionByName(blank.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])).unionByName(blank.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found, name = decontaminate.contamination(docs, benchmark)
    return found.where(~F.col(name)["contaminated"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, documents that it does not take included."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The first stage is a trained model, which SQL cannot express; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
