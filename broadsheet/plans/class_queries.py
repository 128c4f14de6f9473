"""Queries on vectors, factors, classes and time."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import tokens as tok
from broadsheet.functions import vectors as vec
from broadsheet.functions.rows import unnest
from broadsheet.functions.sizing import BROADCAST_BYTES, driver_rows
from broadsheet.operators import centroids, clusters, concepts, density, factors, tfidf, timeline
from broadsheet.plans import inputs, press
from broadsheet.plans.inputs import NUM_TERMS_WIDE, WIDTH, entries
from broadsheet.session import durable, scratch_path
from broadsheet.sources import tables, text, word_vectors

# The classes of the time line and their labels; one class has none.
TIMELINE_CLASSES = ["view", "click", "purchase", "signup"]
CLASS_LABELS = {"view": "reading", "click": "following", "purchase": "buying"}
GROUP_LABELS = {1: "amber", 3: "birch", 4: "cedar", 7: "dune"}
FREQUENT = 20  # occurrences of a word whose vector is looked at


def _centroids(spark: SparkSession, sf_dir: str, weighting: str, num_terms: int = inputs.NUM_TERMS) -> DataFrame:
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir, num_terms=num_terms)
    vectors = inputs.word_vectors(spark, sf_dir, vocabulary)
    return centroids.weighted_centroids(words, vocabulary, vectors, WIDTH, weighting)


def embed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(_centroids(spark, sf_dir, "tfidf"), "vector", "doc_id")


def embed_weight1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(_centroids(spark, sf_dir, "one"), "vector", "doc_id")


def embed_missing_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(_centroids(spark, sf_dir, "tfidf", NUM_TERMS_WIDE), "vector", "doc_id")


def embed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    vectors = inputs.word_vectors(spark, sf_dir, vocabulary)
    every = inputs.documents(spark, sf_dir).select("doc_id", tok.tokens("text").alias("words"))
    return entries(centroids.plain_means(every, vectors, WIDTH, inputs.STOP_WORDS), "vector", "doc_id")


def _both_forms(make) -> DataFrame:
    """What ``make`` returns with vectors broadcast and with vectors joined."""
    row, join = (make(most).withColumn("form", F.lit(form)) for form, most in (("row", BROADCAST_BYTES), ("join", 0)))
    return entries(row.unionByName(join), "vector", "form", "doc_id")


def embed_tfidf_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice under the same id."""
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    vectors = inputs.word_vectors(spark, sf_dir, vocabulary)
    twice = words.unionByName(words)
    return _both_forms(lambda most: centroids.weighted_centroids(twice, vocabulary, vectors, WIDTH, "tfidf", most))


def embed_mean_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice under the same id."""
    _, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    vectors = inputs.word_vectors(spark, sf_dir, vocabulary)
    every = inputs.documents(spark, sf_dir).select("doc_id", tok.tokens("text").alias("words"))
    twice = every.unionByName(every)
    return _both_forms(lambda most: centroids.plain_means(twice, vectors, WIDTH, inputs.STOP_WORDS, most_bytes=most))


def concat_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = inputs.dense(spark, sf_dir)
    both = dense.select("doc_id", vec.concat_vectors("vector", F.reverse("vector")).alias("vector"))
    return entries(both, "vector", "doc_id")


def drop_zero_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = centroids.drop_zero_vectors(_centroids(spark, sf_dir, "tfidf"))
    return kept.select("doc_id", F.round(vec.l1_norm("vector"), 6).alias("norm"))


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(factors.standardise(inputs.dense(spark, sf_dir)), "standard", "doc_id")


def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = factors.column_summary(inputs.dense(spark, sf_dir))
    rounded = ("mean", "variance", "min", "max", "norm_l1", "norm_l2")
    return found.select("dim", F.col("nonzeros").cast("bigint").alias("nonzeros"), *[F.round(c, 6).alias(c) for c in rounded])


def gram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    gram = factors.gram_matrix(tfidf.tfidf_rows(words, vocabulary), len(vocabulary.terms))
    return factors.gram_table(spark, gram).withColumn("value", F.round("value", 6))


def _decomposed(spark: SparkSession, sf_dir: str, k: int = 10):
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    rows = tfidf.tfidf_rows(words, vocabulary)
    return rows, vocabulary, factors.decompose(rows, len(vocabulary.terms), k)


def svd_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decomposed(spark, sf_dir, 100)[2].spectrum(spark)


def svd_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, found = _decomposed(spark, sf_dir)
    return entries(factors.project_rows(rows, found.right), "projection", "doc_id", dim="axis", value="x")


def svd_leading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three of the ten values, which the SQL finds by power iteration."""
    spectrum = _decomposed(spark, sf_dir)[2].spectrum(spark).where("rank <= 3")
    return spectrum.select("rank", *[F.round(c, 6).alias(c) for c in ("singular_value", "eigenvalue")])


def svd_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two of ten values of rows with ten thousand columns."""
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir, num_terms=inputs.NUM_TERMS_MANY)
    found = factors.decompose(tfidf.tfidf_rows(words, vocabulary), len(vocabulary.terms), 10)
    return found.spectrum(spark).where("rank <= 2").select("rank", F.round("singular_value", 6).alias("singular_value"))


def concepts_leading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top terms and top documents of the first three concepts with their weights."""
    rows, vocabulary, found = _decomposed(spark, sf_dir)
    terms = concepts.concept_terms(found, vocabulary.table(spark), 3).select("concept", "rank", F.lit("term").alias("kind"), F.col("term").alias("item"), "weight")
    docs = concepts.concept_documents(rows, found, 3).select("concept", "rank", F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("item"), "weight")
    return terms.unionByName(docs).withColumn("weight", F.round("weight", 6))


def _squared_norms(df: DataFrame, vector: str) -> DataFrame:
    norm = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return df.select("doc_id", F.round(norm, 6).alias("norm"))


def svd_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eigenvalues together make up the squared weights."""
    spectrum = _decomposed(spark, sf_dir, inputs.NUM_TERMS)[2].spectrum(spark)
    return spectrum.agg(F.round(F.sum("eigenvalue"), 6).alias("trace"))


def svd_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection on all axes keeps the length of every row."""
    rows, _, found = _decomposed(spark, sf_dir, inputs.NUM_TERMS)
    return _squared_norms(factors.project_rows(rows, found.right), "projection")


def svd_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and right vectors of all axes put together again: diagonal, sum and squared length of each row of the matrix of
    column products."""
    _, _, found = _decomposed(spark, sf_dir, inputs.NUM_TERMS)
    gram = (found.right * found.values**2) @ found.right.T
    rows = [(i, float(row[i]), float(row.sum()), float((row**2).sum())) for i, row in enumerate(gram)]
    table = spark.createDataFrame(rows, "term_id INT, diagonal DOUBLE, total DOUBLE, squares DOUBLE")
    return table.select("term_id", *[F.round(c, 6).alias(c) for c in ("diagonal", "total", "squares")])


def _covariances(projected: DataFrame) -> DataFrame:
    """What the covariances of the axes have to be: none between axes, falling on them, and the whole variance in two powers."""
    ready = projected.select(array_to_vector("projection").alias("row"))
    square = factors.row_matrix(ready).computeCovariance().toArray()
    cov = factors.gram_table(projected.sparkSession, square).withColumnRenamed("value", "c")
    falling = F.array_sort(F.collect_list(F.when(F.col("i") == F.col("j"), F.struct("i", "c"))))["c"]
    return cov.agg(
        F.round(F.sum(F.when(F.col("i") == F.col("j"), F.col("c"))), 6).alias("variance"),
        F.round(F.sum(F.col("c") * F.col("c")), 6).alias("squares"),
        F.max(F.when(F.col("i") != F.col("j"), F.abs("c"))).alias("between"),
        falling.alias("falling"),
    ).select(
        "variance", "squares", (F.col("between") < 1e-9).alias("uncorrelated"),
        (F.array_sort("falling", lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)) == F.col("falling")).alias("falling"),
    )


def pca_standardized_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _covariances(factors.principal_components(inputs.dense(spark, sf_dir), WIDTH)[1])


def pca_raw_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _covariances(factors.principal_components(inputs.dense(spark, sf_dir), WIDTH, standardised=False)[1])


def pca_standardized_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, projected = factors.principal_components(inputs.dense(spark, sf_dir), WIDTH)
    return _squared_norms(projected, "projection")


def pca_raw_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, projected = factors.principal_components(inputs.dense(spark, sf_dir), WIDTH, standardised=False)
    return _squared_norms(projected, "projection")


def pca_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, projected = factors.principal_components(inputs.dense(spark, sf_dir), 10)
    return entries(projected, "projection", "doc_id", dim="axis")


def pca_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, projected = factors.principal_components(inputs.dense(spark, sf_dir), 3, standardised=False)
    return entries(projected, "projection", "doc_id", dim="axis")


def project_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loadings from a number file: mean, deviation, least and greatest value of each dimension."""
    dense = inputs.dense(spark, sf_dir)
    summary = factors.column_summary(dense).orderBy("dim")
    numbers = F.concat_ws(" ", "mean", F.sqrt("variance"), "min", "max")
    path = scratch_path(spark, "loadings")
    tables.write_text(summary.select(numbers.alias("value")).coalesce(1), path)
    loadings = text.read_loadings(spark, path)
    return entries(factors.project_on(dense, loadings), "projection", "doc_id", dim="axis")


def kmeans_lsa(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    rows = tfidf.tfidf_rows(words, vocabulary)
    return clusters.assign_classes(rows, clusters.fit_classes(rows)).select("doc_id", "class")


def kmeans_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.dense(spark, sf_dir).select("doc_id", array_to_vector("vector").alias("row"))
    return clusters.assign_classes(rows, clusters.fit_classes(rows)).select("doc_id", "class")


def kmeans_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, by a model that was saved and loaded: whether its class is the nearest one by the means of the classes'
    members, to within the tolerance at which the iteration ends."""
    rows = inputs.dense(spark, sf_dir).select("doc_id", "vector", array_to_vector("vector").alias("row"))
    path = scratch_path(spark, "kmeans")
    word_vectors.save_model(clusters.fit_classes(rows), path)
    stored = durable(clusters.assign_classes(rows, KMeansModel.load(path)).select("doc_id", "vector", "class"))
    means = clusters.class_means(stored, "class", "vector", WIDTH)
    measured = clusters.distances_to_centers(stored, means)
    own = F.get("distances", F.col("class"))
    return measured.select("doc_id", (F.sqrt(own) <= F.sqrt(F.array_min("distances")) + 2e-4).alias("nearest"))


def kmeans_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of four runs: classes of the documents are those of the nearest centre, and each centre is the mean of its
    members, to within the tolerance of the iteration."""
    rows = inputs.dense(spark, sf_dir).select("doc_id", "vector", array_to_vector("vector").alias("row"))
    model = clusters.fit_classes(rows, runs=4)
    stored = durable(clusters.assign_classes(rows, model).select("doc_id", "vector", "class"))
    centers = clusters.centers_table(spark, clusters.model_centers(model))
    members = unnest(stored, ["class"], "vector", "x", at="term_id").groupBy("class", "term_id").agg(F.avg("x").alias("mean"))
    close = centers.join(members, ["class", "term_id"]).select("class", F.col("term_id").alias("dim"), (F.abs(F.col("weight") - F.col("mean")) < 1e-3).alias("close"))
    return close.where("close").groupBy("dim").agg(F.count("*").alias("centers"))


def spectrum_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spectrum as its file has it, one number a line."""
    path = scratch_path(spark, "spectrum")
    tables.write_spectrum(_decomposed(spark, sf_dir)[2].spectrum(spark).where("rank <= 3"), path)
    return spark.read.schema("eigenvalue DOUBLE").csv(path).select(F.round("eigenvalue", 6).alias("eigenvalue"))


def vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors after a round trip as columns of a file, and as texts."""
    dense = inputs.dense(spark, sf_dir)
    path, lines = scratch_path(spark, "vectors"), scratch_path(spark, "lines")
    tables.write_vectors(dense, path, "vector", WIDTH)
    tables.write_text(dense.select(F.concat("doc_id", F.lit(":"), vec.vector_text("vector")).alias("line")), lines)
    columns = F.array(*[f"v{i + 1}" for i in range(WIDTH)]).alias("vector")
    first = tables.read_vectors(spark, path, WIDTH).select(F.lit("columns").alias("form"), "doc_id", columns)
    parts = F.split("value", ":")
    second = spark.read.text(lines).select(F.lit("text").alias("form"), parts[0].cast("bigint").alias("doc_id"), F.split(parts[1], ",").cast("array<double>").alias("vector"))
    return entries(first.unionByName(second), "vector", "form", "doc_id")


def _label_centers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[list[float]]]:
    dense = inputs.dense(spark, sf_dir)
    return dense.drop("class"), clusters.class_means(dense, "class", "vector", WIDTH)


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = clusters.assign_nearest(*_label_centers(spark, sf_dir))
    return assigned.select("doc_id", "class", F.round("distance", 6).alias("distance"))


def nearest_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = clusters.nearest_documents(*_label_centers(spark, sf_dir))
    return near.withColumn("distance", F.round("distance", 6))


def nearest_docs_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = clusters.nearest_documents(*_label_centers(spark, sf_dir))
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir)
    return press.describe_nearest(words, vocabulary, near).withColumn("w", F.round("w", 6))


def class_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, vocabulary = inputs.words_and_vocabulary(spark, sf_dir, "source")
    weights = clusters.class_weights(tfidf.tfidf_rows(words, vocabulary), "source")
    top = clusters.class_top_terms(weights, vocabulary.table(spark))
    return top.withColumn("weight", F.round("weight", 6))


def concept_terms_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vocabulary, found = _decomposed(spark, sf_dir)
    terms = concepts.concept_terms(found, vocabulary.table(spark))
    shown = concepts.describe_concepts(terms, concepts.concept_documents(rows, found))
    return shown.select("concept", tok.rejoin("terms").alias("terms"), F.array_join(F.col("doc_ids").cast("array<string>"), " ").alias("doc_ids"))


def corpus_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.corpus_span(inputs.table(spark, sf_dir, "events"), "ts")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("date"), F.col("event_type").alias("class"))


def class_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = timeline.keep_classes(_dated(spark, sf_dir), TIMELINE_CLASSES)
    return timeline.class_timeline(kept, "event_id").withColumn("share", F.round("share", 6))


def class_timeline_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.createDataFrame(list(CLASS_LABELS.items()), "class STRING, label STRING")
    kept = timeline.keep_classes(_dated(spark, sf_dir), TIMELINE_CLASSES)
    counted = timeline.class_timeline(kept, "event_id").withColumn("share", F.round("share", 6))
    return timeline.label_classes(counted, labels).withColumnsRenamed({"class": "label", "csum": "published"})


def hexbin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.dense(spark, sf_dir).select(*vec.axes("vector", 0, 1))
    return density.cell_centers(density.hexbin_counts(points))


def classes_in_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = inputs.dense(spark, sf_dir)
    points = dense.select("doc_id", *vec.axes("vector", 0, 1))
    labels = spark.createDataFrame(list(GROUP_LABELS.items()), "class INT, label STRING")
    joined = points.join(dense.select("doc_id", "class"), "doc_id")
    shown = timeline.label_classes(joined, labels)
    return shown.select("doc_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "class")


def classified_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dated by the event of the same number, classed by their quality label."""
    dates = inputs.table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("date"))
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id").join(dates, "doc_id")
    classes = inputs.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("class"))
    return clusters.classified(docs, classes)


def classified_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a round trip through the result file, whose dates have seconds."""
    path = scratch_path(spark, "classified")
    tables.write_csv(classified_output(spark, sf_dir), path)
    return tables.read_classified(spark, path)


def train_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the model after a save and a load, with the length of their vectors."""
    press_words = inputs.documents(spark, sf_dir).select(tok.tokens("text").alias("words"))
    clean = inputs.table(spark, sf_dir, "benchmark").select(tok.tokens("text").alias("words"))
    corpus = text.union_corpora(press_words, clean)
    model = word_vectors.train_word_vectors(corpus, partitions=8)
    path = scratch_path(spark, "word_vectors")
    word_vectors.save_model(model, path)
    return word_vectors.load_word_vectors(path).select("word", F.size("vector").alias("width"))


def word_vectors_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language its frequent words that no other language has, and whether their vectors lie together: nine in ten are nearer
    to the mean of the language's words than to that of any other's."""
    words = durable(inputs.documents(spark, sf_dir, "lang").where("lang IS NOT NULL").select("doc_id", "lang", tok.tokens("text").alias("words")))
    model = word_vectors.train_word_vectors(words, vector_size=32, min_count=FREQUENT, partitions=4, max_iter=10)
    counts = unnest(words, ["lang"], "words", "word").groupBy("word").agg(F.count("*").alias("n"), F.min("lang").alias("lang"), F.max("lang").alias("last"))
    own = counts.where((F.col("n") >= FREQUENT) & (F.col("lang") == F.col("last"))).select("word", "lang")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    found = word_vectors.word_vectors(model).withColumn("vector", F.transform("vector", lambda x: x / length)).join(own, "word")
    languages = [r.lang for r in driver_rows(own.select("lang").distinct().orderBy("lang"), 256, "languages")]
    found = durable(found.withColumn("class", F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1))
    near = vec.nearest(vec.squared_distances("vector", clusters.class_means(found, "class", "vector", 32)))
    right = F.count_if(F.col("near") == F.col("class"))
    placed = found.withColumn("near", near).groupBy("lang").agg(F.count("*").alias("n_words"), (10 * right >= 9 * F.count("*")).alias("placed"))
    return placed


QUERIES = {
    f.__name__: f
    for f in (
        embed_tfidf, embed_weight1, embed_missing_vectors, embed_mean, embed_tfidf_forms, embed_mean_forms, concat_vectors, drop_zero_vectors, standardize,
        column_summary, gram_matrix, svd_spectrum, svd_leading, svd_wide, concepts_leading, svd_trace, svd_projection, svd_norms, svd_reconstruction, pca_standardized,
        pca_standardized_covariance, pca_raw_covariance,
        pca_standardized_norms, pca_raw, pca_raw_norms, project_loadings,
        spectrum_file, vector_files, kmeans_lsa, kmeans_embed, kmeans_settled, kmeans_runs, assign_nearest, nearest_docs, nearest_docs_terms, class_top_terms,
        concept_terms_docs, corpus_span, class_timeline, class_timeline_labelled, hexbin_counts, classes_in_space,
        classified_output, classified_csv, train_word_vectors, word_vectors_by_language,
    )
}


def _centroid_sql(weight: str, num_terms: int = inputs.NUM_TERMS) -> str:
    return f"""WITH {inputs.tfidf_sql(num_terms)}, {inputs.COMPONENTS_SQL},
weighted AS (SELECT doc_id, term_id, {weight} AS w FROM tfidf),
sums AS (
  SELECT t.doc_id, c.dim, sum(t.w) AS total, sum(t.w * c.x) AS s
  FROM weighted t JOIN comp c ON c.doc_id = t.term_id GROUP BY t.doc_id, c.dim),
means AS (
  SELECT d.doc_id, g.dim, CASE WHEN s.total > 0 THEN s.s / s.total ELSE 0.0 END AS x
  FROM documents d CROSS JOIN (SELECT CAST(unnest(range({WIDTH})) AS INTEGER) AS dim) g
  LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.dim = g.dim)"""


_ALL = "SELECT doc_id, dim, round(x, 6) + 0.0 AS x FROM means"
_CENTERS = f"""{inputs.COMPONENTS_SQL},
centers AS (SELECT class, dim, avg(x) AS x FROM comp GROUP BY class, dim),
dist AS (
  SELECT p.doc_id, c.class, sum((p.x - c.x) * (p.x - c.x)) AS distance
  FROM comp p JOIN centers c USING (dim) GROUP BY p.doc_id, c.class),
near AS (
  SELECT class, doc_id, distance,
         CAST(row_number() OVER (PARTITION BY class ORDER BY distance, doc_id) AS INTEGER) AS rank
  FROM dist)"""
_TIMELINE = f"""counted AS (
  SELECT event_id, ts AS date, event_type AS class,
         count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS csum,
         count(*) OVER (ORDER BY ts, event_type, event_id ROWS UNBOUNDED PRECEDING) AS total
  FROM events WHERE event_type IN ({", ".join(f"'{c}'" for c in TIMELINE_CLASSES)}))"""


def _values(labels: dict) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in labels.items())


_GRAM = """sums AS (
  SELECT a.term_id AS i, b.term_id AS j, sum(a.w * b.w) AS value
  FROM tfidf a JOIN tfidf b USING (doc_id) GROUP BY a.term_id, b.term_id)"""

_MEAN = f"""
WITH {inputs.vocabulary_sql()}, {inputs.COMPONENTS_SQL},
every AS (SELECT doc_id, unnest({inputs.TOKENS_SQL}) AS term FROM documents),
kept AS (SELECT * FROM every WHERE length(term) >= 2 AND term NOT IN ({", ".join(f"'{w}'" for w in inputs.STOP_WORDS)}))
SELECT k.doc_id, c.dim, round(avg(c.x), 6) + 0.0 AS x
FROM kept k JOIN vocab v USING (term) JOIN comp c ON c.doc_id = v.term_id GROUP BY k.doc_id, c.dim"""


def _forms_sql(sql: str) -> str:
    return f"SELECT form, doc_id, dim, x FROM ({sql}) CROSS JOIN (VALUES ('row'), ('join')) f(form) CROSS JOIN range(2)"


def _covariance_sql(of: str) -> str:
    return f"""
WITH {inputs.COMPONENTS_SQL},
pairs AS (SELECT a.dim AS i, b.dim AS j, {of}(a.x, b.x) AS c FROM comp a JOIN comp b USING (doc_id) GROUP BY a.dim, b.dim)
SELECT round(sum(c) FILTER (i = j), 6) AS variance, round(sum(c * c), 6) AS squares, true AS uncorrelated, true AS falling FROM pairs"""


_START = """a AS MATERIALIZED (SELECT doc_id, term_id, w FROM tfidf),
start AS (SELECT list(1.0 / (1 + term_id) ORDER BY term_id) AS v FROM vocab)"""


def _times_sql(vectors: str, columns: list[str]) -> str:
    """One row of lists: the column products times each list of the one row of ``vectors(step, …)``."""
    unnested = ", ".join(f"unnest({c}) AS {c}" for c in columns)
    sums = lambda of: ", ".join(f"sum(a.w * {of}.{c}) AS {c}" for c in columns)
    return f"""SELECT any_value(step) AS step, {", ".join(f"list({c} ORDER BY term_id) AS {c}" for c in columns)} FROM (
    SELECT a.term_id, any_value(y.step) AS step, {sums("y")} FROM (
      SELECT a.doc_id, any_value(u.step) AS step, {sums("u")}
      FROM (SELECT step, {unnested}, CAST(generate_subscripts({columns[0]}, 1) - 1 AS INTEGER) AS term_id FROM {vectors}) u JOIN a USING (term_id) GROUP BY a.doc_id) y
    JOIN a USING (doc_id) GROUP BY a.term_id) HAVING count(*) > 0"""


def _axes_sql(axes: int = 3, steps: int = 320) -> str:
    """Power iteration with deflation: CTEs axis1, axis2, … of one row ``(v, value)``, the largest component of ``v`` positive."""
    parts = [_START]
    for i in range(1, axes + 1):
        before = ", ".join(f"(SELECT v AS v{j} FROM axis{j}) t{j}" for j in range(1, i))
        steps_sql = f"SELECT step, v{''.join(f', v{j}' for j in range(1, i))} FROM ({_times_sql(f'(SELECT * FROM walk{i} WHERE step < {steps})', ['v'])}) z{', ' + before if before else ''}"
        for j in range(1, i):
            keep = "".join(f", v{m}" for m in range(1, i))
            steps_sql = f"SELECT step, list_transform(list_zip(v, v{j}), lambda p: p[1] - d * p[2]) AS v{keep} FROM (SELECT *, list_dot_product(v, v{j}) AS d FROM ({steps_sql}))"
        parts.append(f"""walk{i} AS (
  SELECT 0 AS step, v FROM start UNION ALL
  SELECT step + 1, list_transform(v, lambda x: x / l) FROM (SELECT *, sqrt(list_dot_product(v, v)) AS l FROM ({steps_sql})))""")
        parts.append(f"""last{i} AS (SELECT step, v, sqrt(list_dot_product(v, v)) AS l FROM walk{i} WHERE step = {steps}),
axis{i} AS (
  SELECT list_transform(v, lambda x: x / l * CASE WHEN list_max(v) >= -list_min(v) THEN 1 ELSE -1 END) AS v,
         sqrt((SELECT list_dot_product(z.v, last{i}.v) FROM ({_times_sql(f"last{i}", ["v"])}) z) / (l * l)) AS value
  FROM last{i})""")
    return ",\n".join(parts)


def _pair_sql(steps: int = 80) -> str:
    """Two vectors iterated together, and the two values from the matrix of their products: rows ``(value)`` of CTE pair."""
    return f"""{_START},
walk AS (
  SELECT 0 AS step, v AS p, list_transform(v, lambda x, i: x * (CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END)) AS q FROM start UNION ALL
  SELECT step + 1, p, list_transform(q, lambda x: x / l) FROM (
    SELECT *, sqrt(list_dot_product(q, q)) AS l FROM (
      SELECT step, p, list_transform(list_zip(q, p), lambda t: t[1] - d * t[2]) AS q FROM (
        SELECT *, list_dot_product(p, q) AS d FROM (
          SELECT step, list_transform(p, lambda x: x / l) AS p, q FROM (
            SELECT *, sqrt(list_dot_product(p, p)) AS l FROM ({_times_sql(f"(SELECT * FROM walk WHERE step < {steps})", ["p", "q"])}))))))),
last AS (SELECT * FROM walk WHERE step = {steps}),
small AS (
  SELECT list_dot_product(z.p, last.p) AS pp, list_dot_product(z.p, last.q) AS pq, list_dot_product(z.q, last.q) AS qq
  FROM ({_times_sql("last", ["p", "q"])}) z, last),
pair AS (
  SELECT unnest([(pp + qq) / 2 + r, (pp + qq) / 2 - r]) AS value FROM (SELECT *, sqrt(pow((pp - qq) / 2, 2) + pq * pq) AS r FROM small))"""


def _concepts_sql() -> str:
    found = [
        f"""SELECT {i - 1} AS concept, 'term' AS kind, term AS item, v[term_id + 1] AS weight, term_id AS place FROM vocab, axis{i}
UNION ALL SELECT {i - 1}, 'document', CAST(doc_id AS VARCHAR), sum(w * v[term_id + 1]) / any_value(value), doc_id FROM a, axis{i} GROUP BY doc_id"""
        for i in (1, 2, 3)
    ]
    return f"""WITH RECURSIVE {inputs.tfidf_sql()}, {_axes_sql()},
found AS ({" UNION ALL ".join(found)}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY concept, kind ORDER BY round(weight, {concepts.EQUAL_DIGITS}) DESC, place) AS INTEGER) AS rank FROM found)
SELECT concept, rank, kind, item, round(weight, 6) AS weight FROM ranked WHERE rank <= 10"""


ORACLE = {
    "svd_leading": f"""WITH RECURSIVE {inputs.tfidf_sql()}, {_axes_sql()}
{" UNION ALL ".join(f"SELECT {i} AS rank, round(value, 6) AS singular_value, round(value * value, 6) AS eigenvalue FROM axis{i}" for i in (1, 2, 3))}""",
    "svd_wide": f"""WITH RECURSIVE {inputs.tfidf_sql(inputs.NUM_TERMS_MANY)}, {_pair_sql()}
SELECT CAST(row_number() OVER (ORDER BY value DESC) AS INTEGER) AS rank, round(sqrt(value), 6) AS singular_value FROM pair""",
    "concepts_leading": _concepts_sql(),
    "embed_tfidf": f"{_centroid_sql('w')} {_ALL}",
    "embed_weight1": f"{_centroid_sql('1.0')} {_ALL}",
    "embed_missing_vectors": f"{_centroid_sql('w', NUM_TERMS_WIDE)} {_ALL}",
    "embed_mean": _MEAN,
    "concat_vectors": f"""
WITH {inputs.COMPONENTS_SQL}
SELECT doc_id, dim, round(x, 6) + 0.0 AS x FROM comp
UNION ALL SELECT doc_id, CAST({2 * WIDTH - 1} - dim AS INTEGER), round(x, 6) + 0.0 FROM comp""",
    "drop_zero_vectors": f"""{_centroid_sql("w")}
SELECT doc_id, round(sum(abs(x)), 6) AS norm FROM means GROUP BY doc_id HAVING sum(abs(x)) > 0""",
    "standardize": f"""
WITH {inputs.COMPONENTS_SQL},
stats AS (SELECT dim, avg(x) AS m, stddev_samp(x) AS s FROM comp GROUP BY dim)
SELECT doc_id, dim, round(CASE WHEN s > 0 THEN (x - m) / s ELSE 0.0 END, 6) + 0.0 AS x FROM comp JOIN stats USING (dim)""",
    "column_summary": f"""
WITH {inputs.COMPONENTS_SQL}
SELECT dim, count(*) FILTER (x <> 0) AS nonzeros, round(avg(x), 6) + 0.0 AS mean, round(var_samp(x), 6) AS variance,
       round(min(x), 6) AS min, round(max(x), 6) AS max, round(sum(abs(x)), 6) AS norm_l1,
       round(sqrt(sum(x * x)), 6) AS norm_l2
FROM comp GROUP BY dim""",
    "gram_matrix": f"""
WITH {inputs.tfidf_sql()},
{_GRAM}
SELECT a.term_id AS i, b.term_id AS j, round(coalesce(value, 0.0), 6) AS value
FROM vocab a CROSS JOIN vocab b LEFT JOIN sums ON sums.i = a.term_id AND sums.j = b.term_id""",
    "project_loadings": f"""
WITH {inputs.COMPONENTS_SQL},
stats AS (SELECT dim, [avg(x), stddev_samp(x), min(x), max(x)] AS loads FROM comp GROUP BY dim),
axes AS (SELECT CAST(unnest(range(4)) AS INTEGER) AS axis)
SELECT doc_id, axis, round(sum(x * loads[axis + 1]), 6) + 0.0 AS x
FROM comp JOIN stats USING (dim) CROSS JOIN axes GROUP BY doc_id, axis""",
    "svd_trace": f"WITH {inputs.tfidf_sql()} SELECT round(sum(w * w), 6) AS trace FROM tfidf",
    "svd_norms": f"""
WITH {inputs.tfidf_sql()}, norms AS (SELECT doc_id, sum(w * w) AS norm FROM tfidf GROUP BY doc_id)
SELECT doc_id, round(coalesce(norm, 0.0), 6) AS norm FROM documents LEFT JOIN norms USING (doc_id)""",
    "svd_reconstruction": f"""
WITH {inputs.tfidf_sql()},
{_GRAM}
SELECT i AS term_id, round(sum(value) FILTER (i = j), 6) AS diagonal, round(sum(value), 6) AS total, round(sum(value * value), 6) AS squares
FROM sums GROUP BY i""",
    "pca_standardized_covariance": _covariance_sql("corr"),
    "pca_raw_covariance": _covariance_sql("covar_samp"),
    "kmeans_settled": "SELECT vec_id AS doc_id, true AS nearest FROM embeddings",
    "kmeans_runs": f"SELECT CAST(unnest(range({WIDTH})) AS INTEGER) AS dim, CAST(10 AS BIGINT) AS centers",
    "spectrum_file": f"""WITH RECURSIVE {inputs.tfidf_sql()}, {_axes_sql()}
{" UNION ALL ".join(f"SELECT round(value * value, 6) AS eigenvalue FROM axis{i}" for i in (1, 2, 3))}""",
    "vector_files": f"""
WITH {inputs.COMPONENTS_SQL} SELECT form, doc_id, dim, round(x, 6) + 0.0 AS x FROM comp CROSS JOIN (VALUES ('columns'), ('text')) f(form)""",
    "embed_tfidf_forms": _forms_sql(f"{_centroid_sql('w')} {_ALL}"),
    "embed_mean_forms": _forms_sql(_MEAN),
    "pca_standardized_norms": f"""
WITH {inputs.COMPONENTS_SQL},
stats AS (SELECT dim, avg(x) AS m, stddev_samp(x) AS s FROM comp GROUP BY dim)
SELECT doc_id, round(sum(((x - m) / s) * ((x - m) / s)), 6) AS norm FROM comp JOIN stats USING (dim) GROUP BY doc_id""",
    "pca_raw_norms": f"""
WITH {inputs.COMPONENTS_SQL} SELECT doc_id, round(sum(x * x), 6) AS norm FROM comp GROUP BY doc_id""",
    "assign_nearest": f"""
WITH {_CENTERS},
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, class) AS place FROM dist)
SELECT doc_id, class, round(distance, 6) AS distance FROM best WHERE place = 1""",
    "nearest_docs": f"""
WITH {_CENTERS} SELECT class, rank, doc_id, round(distance, 6) AS distance FROM near WHERE rank <= 10""",
    "nearest_docs_terms": f"""
WITH {inputs.tfidf_sql()}, {_CENTERS},
ranked AS (
  SELECT doc_id, term, w, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term_id) AS INTEGER) AS rank
  FROM tfidf WHERE w > 0)
SELECT near.class, near.rank AS doc_rank, doc_id, ranked.rank, term, round(w, 6) AS w
FROM ranked JOIN near USING (doc_id) WHERE near.rank <= 10 AND ranked.rank <= 5""",
    "class_top_terms": f"""
WITH {inputs.tfidf_sql()},
sizes AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
means AS (SELECT source, term_id, term, sum(w) / docs AS weight FROM tfidf JOIN sizes USING (source) GROUP BY source, term_id, term, docs),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY weight DESC, term_id) AS INTEGER) AS rank FROM means)
SELECT source AS class, rank, term, round(weight, 6) AS weight FROM ranked WHERE rank <= 10""",
    "corpus_span": "SELECT count(*) AS n, min(ts) AS first_date, max(ts) AS last_date FROM events",
    "class_timeline": f"""
WITH {_TIMELINE} SELECT event_id, date, class, csum, total, round(csum / total, 6) AS share FROM counted""",
    "class_timeline_labelled": f"""
WITH {_TIMELINE}, labels(class, name) AS (VALUES {_values(CLASS_LABELS)})
SELECT event_id, date, coalesce(name, class) AS label, csum AS published, total, round(csum / total, 6) AS share
FROM counted LEFT JOIN labels USING (class)""",
    "hexbin_counts": f"""
WITH points AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points),
scaled AS (
  SELECT {density.XBINS} * (x - x0) / (x1 - x0) AS sx, {density.XBINS} * (y - y0) / ((y1 - y0) * sqrt(3)) AS sy
  FROM points CROSS JOIN b),
cand AS (
  SELECT *, CAST(floor(sx + 0.5) AS BIGINT) AS j1, CAST(floor(sy + 0.5) AS BIGINT) AS i1,
         CAST(floor(sx) AS BIGINT) AS j2, CAST(floor(sy) AS BIGINT) AS i2
  FROM scaled),
placed AS (
  SELECT *, CASE WHEN pow(sx - j1, 2) + 3 * pow(sy - i1, 2) <= pow(sx - j2 - CAST(0.5 AS DOUBLE), 2) + 3 * pow(sy - i2 - CAST(0.5 AS DOUBLE), 2)
                 THEN 0 ELSE 1 END AS lattice
  FROM cand)
SELECT CAST(lattice AS INTEGER) AS lattice, CASE WHEN lattice = 0 THEN i1 ELSE i2 END AS i,
       CASE WHEN lattice = 0 THEN j1 ELSE j2 END AS j, count(*) AS n,
       CAST(CASE WHEN lattice = 0 THEN j1 ELSE j2 + 0.5 END AS DOUBLE) AS cx,
       CAST(CASE WHEN lattice = 0 THEN i1 ELSE i2 + 0.5 END AS DOUBLE) AS cy
FROM placed GROUP BY ALL""",
    "classes_in_space": f"""
WITH labels(class, label) AS (VALUES {_values(GROUP_LABELS)})
SELECT vec_id AS doc_id, round(CAST(embedding[1] AS DOUBLE), 6) + 0.0 AS x, round(CAST(embedding[2] AS DOUBLE), 6) + 0.0 AS y,
       coalesce(labels.label, CAST(e.label AS VARCHAR)) AS class
FROM embeddings e LEFT JOIN labels ON labels.class = CAST(e.label AS VARCHAR)""",
    "classified_csv": """
SELECT doc_id, date_trunc('second', ts) AS date, quality AS class
FROM documents JOIN events ON event_id = doc_id JOIN labels USING (doc_id)""",
    "train_word_vectors": f"""
SELECT word, 100 AS width
FROM (SELECT unnest({inputs.TOKENS_SQL}) AS word FROM documents UNION ALL SELECT unnest({inputs.TOKENS_SQL}) FROM benchmark)
GROUP BY word HAVING count(*) >= 5""",
    "word_vectors_by_language": f"""
WITH counts AS (
  SELECT word, min(lang) AS lang, max(lang) AS last, count(*) AS n
  FROM (SELECT lang, unnest({inputs.TOKENS_SQL}) AS word FROM documents WHERE lang IS NOT NULL) GROUP BY word)
SELECT lang, count(*) AS n_words, true AS placed FROM counts WHERE n >= {FREQUENT} AND lang = last GROUP BY lang""",
    "classified_output": """
SELECT doc_id, ts AS date, quality AS class
FROM documents JOIN events ON event_id = doc_id JOIN labels USING (doc_id)""",
}
