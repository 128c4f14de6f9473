"""The given tables in the shapes the operators take, and the SQL fragments that mirror them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.rows import unnest
from broadsheet.functions.sizing import spread_out
from broadsheet.functions.tokens import tokens, usable
from broadsheet.operators.lemmas import document_words
from broadsheet.operators.vocabulary import Vocabulary, build_vocabulary

NUM_TERMS = 1000
NUM_TERMS_WIDE = 1500  # more terms than there are vectors at the smaller scales, so look-ups miss
NUM_TERMS_MANY = 10_000  # more than a square matrix of column products is laid out for
WIDTH = 64

# Function words of the four languages of the test documents.
STOP_WORDS = [
    "the", "and", "for", "that", "with", "are", "this", "from", "was", "have", "not",
    "der", "die", "und", "das", "den", "von", "ist", "nicht", "ein", "eine", "mit",
    "les", "des", "une", "que", "pour", "dans", "est", "pas", "sur", "par",
    "los", "las", "del", "con", "por", "para", "una",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return spread_out(table(spark, sf_dir, "documents").select("doc_id", *extra, "text"))


def words(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Documents with their vocabulary words."""
    return document_words(documents(spark, sf_dir, *extra), STOP_WORDS)


def words_and_vocabulary(
    spark: SparkSession, sf_dir: str, *extra: str, num_terms: int = NUM_TERMS
) -> tuple[DataFrame, Vocabulary]:
    tokenised = documents(spark, sf_dir).select(tokens("text").alias("words"))
    vocabulary = build_vocabulary(tokenised, num_terms, usable(F.col("term"), STOP_WORDS))
    return words(spark, sf_dir, *extra), vocabulary


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as ``(doc_id, vector, class)``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").alias("class")
    )


def word_vectors(spark: SparkSession, sf_dir: str, vocabulary: Vocabulary) -> DataFrame:
    """Stand-in for a trained model: the embedding with a term's number is the vector of that term."""
    terms = vocabulary.table(spark).select("term_id", F.col("term").alias("word"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("term_id"), F.col("embedding").alias("vector"))
    return vectors.join(F.broadcast(terms), "term_id").select("word", "vector")


def entries(df: DataFrame, vector: str, *keys: str, dim: str = "dim", value: str = "x") -> DataFrame:
    """Vectors as one row per component, rounded for comparison."""
    return unnest(df, list(keys), vector, value, at=dim).withColumn(value, F.round(value, 6))


TOKENS_SQL = "list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda w: w <> '')"

_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)

WORDS_SQL = rf"""words AS (
  SELECT doc_id, source, list_filter({TOKENS_SQL},
    lambda w: length(w) >= 3 AND regexp_matches(w, '^\p{{L}}+$') AND w NOT IN ({_STOP_SQL})) AS words
  FROM documents)"""


def vocabulary_sql(num_terms: int = NUM_TERMS) -> str:
    """CTEs words, tf and vocab."""
    return f"""{WORDS_SQL},
tf AS (
  SELECT doc_id, source, n, term, count(*) AS f
  FROM (SELECT doc_id, source, len(words) AS n, unnest(words) AS term FROM words)
  GROUP BY doc_id, source, n, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
top AS (SELECT term, df FROM dfs ORDER BY df DESC, term LIMIT {num_terms}),
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY df DESC, term) - 1 AS INTEGER) AS term_id, term, df,
         ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / df) AS idf
  FROM top)"""


def tfidf_sql(num_terms: int = NUM_TERMS) -> str:
    """CTEs words, tf, vocab and tfidf."""
    return f"""{vocabulary_sql(num_terms)},
tfidf AS (
  SELECT doc_id, source, term_id, term, f, n, CAST(f AS DOUBLE) / n * idf AS w
  FROM tf JOIN vocab USING (term))"""


COMPONENTS_SQL = """comp AS (
  SELECT vec_id AS doc_id, label AS class, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings)"""
