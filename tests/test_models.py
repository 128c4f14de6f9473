import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import Word2VecModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from broadsheet.operators import centroids, clusters, concepts, factors, tfidf, vocabulary
from broadsheet.sources import word_vectors


def vectors(df, column="vector"):
    return {r.doc_id: list(r[column]) for r in df.collect()}


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(60, 4)) @ np.diag([4.0, 2.0, 1.0, 0.5])
    rows[:, 3] = 3.0
    data = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    return rows, spark.createDataFrame(data, "doc_id BIGINT, vector ARRAY<DOUBLE>").repartition(4)


def test_weighted_centroids(spark, mini_with_empty, mini, fruit_vectors):
    found = vocabulary.build_vocabulary(mini, 10)
    by_weight = vectors(centroids.weighted_centroids(mini_with_empty, found, fruit_vectors, 2))
    assert by_weight == {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}
    by_one = vectors(centroids.weighted_centroids(mini_with_empty, found, fruit_vectors, 2, "one"))
    assert by_one == {1: [0.5, 0.5], 2: [0.0, 1.0], 3: [0.0, 1.0], 4: [0.0, 0.0]}
    with pytest.raises(ValueError):
        centroids.weighted_centroids(mini, found, fruit_vectors, 2, "none")


def test_words_outside_the_vocabulary_do_not_count(spark, mini, fruit_vectors):
    found = vocabulary.Vocabulary(["apple"], [1], 3)
    assert vectors(centroids.weighted_centroids(mini, found, fruit_vectors, 2, "one"))[1] == [1.0, 0.0]


def test_centroids_of_a_wide_vocabulary(spark, mini_with_empty, mini, fruit_vectors, monkeypatch):
    found = vocabulary.build_vocabulary(mini, 10)
    expected = {w: vectors(centroids.weighted_centroids(mini_with_empty, found, fruit_vectors, 2, w)) for w in ("tfidf", "one")}
    monkeypatch.setattr(centroids, "BROADCAST_BYTES", 0)
    for weighting, want in expected.items():
        assert vectors(centroids.weighted_centroids(mini_with_empty, found, fruit_vectors, 2, weighting)) == want


def test_plain_means(spark, mini_with_empty, fruit_vectors):
    got = vectors(centroids.plain_means(mini_with_empty, fruit_vectors, 2))
    assert sorted(got) == [1, 2, 3]
    assert got[1] == pytest.approx([2 / 3, 1 / 3]) and got[2] == [0.0, 1.0]
    kept = vectors(centroids.plain_means(mini_with_empty, fruit_vectors, 2, drop_zero=False))
    assert kept[4] == [0.0, 0.0] and len(kept) == 4
    stopped = vectors(centroids.plain_means(mini_with_empty, fruit_vectors, 2, stop_words=["banana"]))
    assert stopped == {1: [1.0, 0.0]}


def test_plain_means_do_not_depend_on_the_blocks(spark, mini_with_empty, fruit_vectors, monkeypatch):
    whole = vectors(centroids.plain_means(mini_with_empty.coalesce(1), fruit_vectors, 2))
    monkeypatch.setattr(centroids, "BLOCK_WORDS", 2)
    blocks = vectors(centroids.plain_means(mini_with_empty.coalesce(1), fruit_vectors, 2))
    assert sorted(blocks) == sorted(whole)
    assert all(blocks[doc] == pytest.approx(whole[doc]) for doc in whole)


def test_plain_means_with_vectors_too_many_to_broadcast(spark, mini_with_empty, fruit_vectors, monkeypatch):
    small = vectors(centroids.plain_means(mini_with_empty, fruit_vectors, 2, drop_zero=False))
    monkeypatch.setattr("broadsheet.operators.joins.fits_broadcast", lambda *_: False)
    monkeypatch.setattr("broadsheet.operators.centroids.fits_broadcast", lambda *_: False)
    assert vectors(centroids.plain_means(mini_with_empty, fruit_vectors, 2, drop_zero=False)) == small


def test_decomposition(spark, cloud):
    rows, df = cloud
    ready = df.withColumn("row", array_to_vector("vector"))
    found = factors.decompose(ready, 4, 3)
    assert found.values == pytest.approx(np.linalg.svd(rows, compute_uv=False)[:3])
    assert found.right.T @ found.right == pytest.approx(np.eye(3), abs=1e-9)
    spectrum = found.spectrum(spark).collect()
    assert [r.eigenvalue for r in spectrum] == pytest.approx([v * v for v in found.values])
    projected = vectors(factors.project_rows(ready, found.right), "projection")
    got = np.array([projected[i] for i in range(60)])
    assert got == pytest.approx(rows @ found.right)
    assert (got**2).sum(axis=0) == pytest.approx(found.values**2)
    with pytest.raises(ValueError):
        factors.gram_matrix(ready, factors.MAX_COLUMNS + 1)


def test_decomposition_agrees_with_the_built_in_one(spark, cloud):
    ready = cloud[1].withColumn("row", array_to_vector("vector"))
    built_in = factors.row_matrix(ready).computeSVD(3)
    assert factors.decompose(ready, 4, 3).values == pytest.approx(built_in.s.toArray())


def test_projection_keeps_documents_of_zeros(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 2.0])], "doc_id BIGINT, v ARRAY<DOUBLE>")
    ready = df.withColumn("row", array_to_vector("v"))
    assert vectors(factors.project_rows(ready, np.array([[1.0], [3.0]])), "projection") == {1: [0.0], 2: [6.0]}


def test_standardise_and_components(spark, cloud):
    rows, df = cloud
    standard = vectors(factors.standardise(df), "standard")
    got = np.array([standard[i] for i in range(60)])
    assert got[:, :3].mean(axis=0) == pytest.approx(np.zeros(3), abs=1e-12)
    assert got[:, :3].std(axis=0, ddof=1) == pytest.approx(np.ones(3))
    assert (got[:, 3] == 0).all()
    model, projected = factors.principal_components(df, 2)
    axes = model.pc.toArray()
    assert np.array([vectors(projected, "projection")[i] for i in range(60)]) == pytest.approx(got @ axes)
    model, projected = factors.principal_components(df, 2, standardised=False)
    uncentred = np.array([vectors(projected, "projection")[i] for i in range(60)])
    assert uncentred == pytest.approx(rows @ model.pc.toArray())


def test_column_summary(spark, cloud):
    rows, df = cloud
    for r in factors.column_summary(df).collect():
        column = rows[:, r["dim"]]
        expected = [column.mean(), column.var(ddof=1), (column != 0).sum(), column.min(), column.max()]
        assert [r["mean"], r["variance"], r["nonzeros"], r["min"], r["max"]] == pytest.approx(expected)
        assert r["norm_l1"] == pytest.approx(abs(column).sum()) and r["norm_l2"] == pytest.approx(np.linalg.norm(column))


def test_loadings(spark, cloud):
    rows, df = cloud
    loadings = [[1.0, 0.0], [0.0, 2.0], [0.5, 0.5], [-1.0, 0.0]]
    got = vectors(factors.project_on(df, loadings), "projection")
    assert np.array([got[i] for i in range(60)]) == pytest.approx(rows @ np.array(loadings))


def test_kmeans(spark, cloud, tmp_path):
    rows, df = cloud
    ready = df.withColumn("row", array_to_vector("vector"))
    model = clusters.fit_classes(ready, k=4)
    assigned = clusters.assign_classes(ready, model).select("doc_id", "class").collect()
    assert len(assigned) == 60
    centers = np.array(clusters.model_centers(model))
    for r in assigned:
        assert r["class"] == ((rows[r.doc_id] - centers) ** 2).sum(axis=1).argmin()
    again = clusters.fit_classes(ready, k=4)
    assert clusters.model_centers(again) == clusters.model_centers(model)
    best = clusters.fit_classes(ready, k=4, runs=3)
    assert best.summary.trainingCost <= model.summary.trainingCost
    word_vectors.save_model(model, str(tmp_path / "kmeans"))
    word_vectors.save_model(model, str(tmp_path / "kmeans"))
    assert clusters.model_centers(KMeansModel.load(str(tmp_path / "kmeans"))) == clusters.model_centers(model)


def test_nearest_documents(spark, cloud):
    rows, df = cloud
    centers = [[0.0, 0.0, 0.0, 3.0], [4.0, 0.0, 0.0, 3.0]]
    near = clusters.nearest_documents(df, centers, 5)
    for c, center in enumerate(centers):
        expected = ((rows - np.array(center)) ** 2).sum(axis=1).argsort(kind="stable")[:5].tolist()
        assert [r.doc_id for r in near.where(F.col("class") == c).orderBy("rank").collect()] == expected
    assert clusters.chosen_documents(df, near).count() == near.select("doc_id").distinct().count()
    tie = spark.createDataFrame([(9, [0.0]), (2, [2.0])], "doc_id BIGINT, vector ARRAY<DOUBLE>")
    assert [r.doc_id for r in clusters.nearest_documents(tie, [[1.0]], 2).orderBy("rank").collect()] == [2, 9]
    assert clusters.assign_nearest(tie, [[1.0], [1.0]]).where("class = 0").count() == 2


def test_class_terms_break_ties_by_term(spark, mini):
    table = vocabulary.build_vocabulary(mini, 10).table(spark)
    weights = clusters.centers_table(spark, [[0.1, 0.5, 0.5], [0.9, 0.0, 0.1]])
    top = clusters.class_top_terms(weights, table, 2)
    lines = {r["class"]: r.terms for r in clusters.class_description(top).collect()}
    assert lines == {0: "apple,cherry", 1: "banana,cherry"}


def test_classified_is_ordered_with_undated_last(spark):
    docs = spark.createDataFrame([(1, "b"), (2, "a"), (4, "c"), (3, None)], "doc_id BIGINT, date STRING")
    classes = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4)], "doc_id BIGINT, class INT")
    assert [r.doc_id for r in clusters.classified(docs, classes).collect()] == [2, 1, 4, 3]


def test_concepts(spark, mini):
    found = vocabulary.build_vocabulary(mini, 10)
    rows = tfidf.tfidf_rows(mini, found)
    parts = factors.decompose(rows, 3, 2)
    terms = concepts.concept_terms(parts, found.table(spark), 2, 1).collect()
    assert len(terms) == 2
    documents = concepts.concept_documents(rows, parts, 2, 3)
    assert documents.count() == 6
    left = vectors(concepts.left_vectors(rows, parts, 2), "projection")
    u = np.array([left[i] for i in (1, 2, 3)])
    assert u.T @ u == pytest.approx(np.eye(2), abs=1e-9)
    shown = concepts.describe_concepts(concepts.concept_terms(parts, found.table(spark), 2, 3), documents)
    assert sorted(r.concept for r in shown.collect()) == [0, 1]


def test_word_vector_training_and_loading(spark, tmp_path):
    corpus = spark.createDataFrame([(["a", "b", "c"] * 4,)] * 5, "words ARRAY<STRING>")
    model = word_vectors.train_word_vectors(corpus, vector_size=3, min_count=2)
    word_vectors.save_model(model, str(tmp_path / "w"))
    table = word_vectors.load_word_vectors(str(tmp_path / "w"))
    assert sorted(r.word for r in table.collect()) == ["a", "b", "c"]
    assert all(len(r.vector) == 3 for r in table.collect())
    assert isinstance(Word2VecModel.load(str(tmp_path / "w")), Word2VecModel)


def test_wide_matrices_decompose_as_narrow_ones(spark, monkeypatch):
    rng = np.random.default_rng(7)
    matrix = rng.random((40, 9))
    rows = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(matrix.tolist())], ["doc_id", "row"])
    narrow = factors.decompose(rows, 9, 4)
    monkeypatch.setattr(factors, "MAX_COLUMNS", 8)
    wide = factors.decompose(rows, 9, 4)
    assert np.allclose(wide.values, np.linalg.svd(matrix)[1][:4]) and np.allclose(wide.right, narrow.right, atol=1e-6)
    projected = {r.doc_id: r.projection for r in factors.project_rows(rows, wide.right).collect()}
    assert np.allclose([projected[i] for i in range(40)], matrix @ narrow.right, atol=1e-6)


@pytest.mark.parametrize("most_bytes", [1 << 20, 0])
def test_both_forms_of_centroids_keep_rows_apart(spark, most_bytes):
    rows = [(1, ["cats"]), (1, ["sat"]), (None, ["cats", "sat"]), (2, []), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, words array<string>")
    vectors = spark.createDataFrame([("cats", [1.0, 0.0]), ("cats", [3.0, 0.0]), ("sat", [0.0, 2.0]), (None, [9.0, 9.0])], "word string, vector array<double>")
    expected = sorted(map(str, [(1, [1.0, 0.0]), (1, [0.0, 2.0]), (None, [0.5, 1.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0])]))
    means = centroids.plain_means(docs, vectors, 2, drop_zero=False, most_bytes=most_bytes).collect()
    assert sorted(str((r.doc_id, r.vector)) for r in means) == expected
    known = vocabulary.Vocabulary(["cats", "sat"], [1, 1], 2)
    weighted = centroids.weighted_centroids(docs, known, vectors, 2, "one", most_bytes).collect()
    assert sorted(str((r.doc_id, r.vector)) for r in weighted) == expected


def test_square_matrix_leaves_the_driver_by_rows(spark):
    gram, sent = np.arange(12.0).reshape(4, 3)[:3] / 7, []

    class Session:
        def createDataFrame(self, data, schema):
            sent.append(len(data))
            return spark.createDataFrame(data, schema)

    table = factors.gram_table(Session(), gram)
    assert sent == [3] and table.dtypes == [("i", "int"), ("j", "int"), ("value", "double")]
    assert sorted(map(tuple, table.collect())) == [(i, j, gram[i, j]) for i in range(3) for j in range(3)]
    assert factors.gram_table(spark, np.zeros((0, 0))).count() == 0


def test_wide_decompositions_equal_narrow_ones_and_keep_small_values(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    a = (rng.random((300, 50)) < 0.15) * rng.random((300, 50))
    a[:, 44:] *= 1e-6
    a[7] = 0
    rows = [(i, Vectors.sparse(50, [(j, float(x)) for j, x in enumerate(r) if x])) for i, r in enumerate(a)]
    df = spark.createDataFrame(rows, ["doc_id", "row"]).repartition(5)
    true = np.linalg.svd(a, compute_uv=False)
    wide, narrow = factors.decompose(df, 50, 8, square_columns=0), factors.decompose(df, 50, 8)
    assert wide.values == pytest.approx(true[:8], rel=1e-10)
    assert wide.right == pytest.approx(narrow.right, abs=1e-7)
    every = factors.decompose(df, 50, 50, square_columns=0)
    assert every.values == pytest.approx(true, rel=1e-7) and true[-1] < 1e-5
    assert every.right.T @ every.right == pytest.approx(np.eye(50), abs=1e-10)


def test_runs_of_kmeans_share_their_passes(spark, cloud, monkeypatch):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(4, 3)) * 30
    points = np.vstack([m + rng.normal(size=(40, 3)) for m in middles])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "doc_id BIGINT, vector ARRAY<DOUBLE>")
    df = df.withColumn("row", array_to_vector("vector")).repartition(4)
    passes = []
    one_pass = clusters._class_sums
    monkeypatch.setattr(clusters, "_class_sums", lambda rows, centers: passes.append(len(centers)) or one_pass(rows, centers))
    centers, costs = clusters.fit_runs(df, "row", 4, runs=6)
    assert len(costs) == 6 and passes[0] == 6 and len(passes) < 40 and passes == sorted(passes, reverse=True)
    single = clusters.fit_classes(df, k=4)
    assert min(costs) <= single.summary.trainingCost * (1 + 1e-6)
    found = ((points[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert min(costs) == pytest.approx(found, rel=1e-3)
    model = clusters.fit_classes(df, k=4, runs=6)
    assert np.sort(np.array(clusters.model_centers(model)), axis=0) == pytest.approx(np.sort(centers, axis=0))
    assert clusters.assign_classes(df, model).select("class").distinct().count() == 4


def test_concept_documents_keep_candidates_per_task(spark):
    from pyspark.ml.linalg import Vectors

    from broadsheet.operators import concepts

    rng = np.random.default_rng(2)
    a = rng.random((90, 5))
    a[10:20] = a[0]  # equal documents: ties by id
    rows = [(i, Vectors.dense(r)) for i, r in enumerate(a)] + [(None, Vectors.dense(np.ones(5) * 9))]
    df = spark.createDataFrame(rows, ["doc_id", "row"])
    found = factors.decompose(df.where("doc_id IS NOT NULL"), 5, 3)
    got = {(r.concept, r["rank"]): r.doc_id for r in concepts.concept_documents(df.repartition(7), found, 3, 12).collect()}
    left = (a @ found.right / found.values).round(10)
    for c in range(3):
        expected = sorted(range(90), key=lambda i: (-left[i, c], i))[:12]
        assert [got[c, r + 1] for r in range(12)] == expected


def test_terms_are_numbered_alike_on_the_driver_and_as_a_table(spark):
    from broadsheet.operators import vocabulary

    docs = spark.createDataFrame([(i, [f"w{j}" for j in range(i % 7, 40)]) for i in range(60)], "doc_id BIGINT, words ARRAY<STRING>")
    frequencies = vocabulary.document_frequencies(docs)
    expected = sorted(map(tuple, vocabulary.most_frequent(frequencies, 25).collect()))
    assert sorted(map(tuple, vocabulary.number_terms(frequencies, 25, parts=6).collect())) == expected
    assert [r.term_id for r in vocabulary.number_terms(frequencies).orderBy("term_id").collect()] == list(range(40))
    assert vocabulary.number_terms(frequencies.limit(0)).count() == 0


def test_broadcasts_are_bounded_by_their_texts(spark):
    from broadsheet.functions.sizing import fits_broadcast

    few = spark.createDataFrame([("x" * 1000, ["y" * 500, None], 1), (None, None, 2)], "a STRING, b ARRAY<STRING>, c INT")
    assert fits_broadcast(few, 10, 1552) and not fits_broadcast(few, 10, 1551)
    assert not fits_broadcast(few, 10, 10_000, most_rows=1) and fits_broadcast(few.limit(0), 10, 0)


def test_class_weights_are_means_of_sparse_rows(spark):
    from pyspark.ml.linalg import Vectors

    rows = [("a", Vectors.sparse(4, {0: 2.0, 3: 1.0})), ("a", Vectors.dense([0.0, 4.0, 0.0, 0.0])), (None, Vectors.sparse(4, {2: 5.0})), ("b", Vectors.sparse(4, {}))]
    found = clusters.class_weights(spark.createDataFrame(rows, ["kind", "row"]).repartition(3), "kind").collect()
    assert sorted(((r["class"] or "", r.term_id, r.weight) for r in found)) == [("", 2, 5.0), ("a", 0, 1.0), ("a", 1, 2.0), ("a", 3, 0.5)]
