"""URL filter, mixing, the n-gram join, the two classifiers and the pipeline on awkward rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import graph, jaccard_join, mixing, quality_gam, toxicity, url_filter
from broadsheet.llm.samples import fold

DOCS = "doc_id bigint, text string, source string"


# url filter


def test_rules_and_reputations(spark):
    rules = [("allow", "org", "/"), ("block", "a.org", "/es/")]
    good = [("http://good.x.com/1", 1)] * 30 + [("http://bad.x.com/1", 0)] * 30 + [("http://bad.x.com/1", None)]
    urls = ["HTTP://A.ORG/es/1?q", "x://b.a.org/en", "http://bad.x.com#f", "http://good.x.com/p?x://y", "http://new.x.com", None, "none", "a://b://c/d", ""]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(2, urls[2])], "page_id bigint, url string").selectExpr("*", "1 AS host", "2 AS _n_pages")
    out = url_filter.filter_urls(pages, spark.createDataFrame(good, "url string, good int"), rules).collect()
    rows = {r.page_id: r for r in out}
    assert len(out) == 10
    assert [(rows[i].host_, rows[i].path) for i in range(4)] == [("a.org", "/es/1"), ("b.a.org", "/en"), ("bad.x.com", ""), ("good.x.com", "/p")]
    assert [rows[i].rule for i in range(3)] == ["a.org/es/", "org/", None]
    assert [rows[i].verdict for i in range(9)] == ["block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert rows[2].good_mean < rows[4].good_mean < rows[3].good_mean
    none = spark.createDataFrame([], "url string, good int")
    assert {r.verdict for r in url_filter.filter_urls(pages, none).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), none).count() == 0


# mixing


def test_targets_stop_at_the_cap():
    wanted = mixing.targets({"a": 1, "b": 100, None: 100})
    assert wanted["a"] == 3 and wanted["b"] == pytest.approx(198 * 2 / 3) and sum(wanted.values()) == pytest.approx(201)
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 300), f"s{i % 5}") for i in range(1500)] + [(1, None, "s0"), (2, "", None), (3, "x\u2003y z", None), (None, "a b", "s1"), (None, "a b", "s1")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS rate")
    first = mixing.mix(docs).collect()
    assert len(first) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in first)
    for source in {r.source for r in first}:
        own = [r for r in first if r.source == source]
        assert own[0].source_size == sum(r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.02 * own[0].target + 2
    key = lambda rows: sorted(map(str, rows))
    assert key(first) == key(mixing.mix(docs.repartition(3)).collect())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_priors_tilt_the_rates(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 500 else "b", 4.0 if i % 2 else 0.5) for i in range(1000)], DOCS + ", prior double")
    taken = {r.odd: r.n for r in mixing.mix(docs, prior="prior").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("n")).collect()}
    assert taken[1] > 3 * taken[0] and abs(taken[0] + taken[1] - 10_000) < 50


# n-gram join


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same = rows[a][0] == rows[b][0] and rows[a][0] is not None and sets[a] and sets[b]
            if rows[a][0] is not None and rows[b][0] is not None and (same or (both and 100 * both >= 75 * len(sets[a] | sets[b]))):
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    return sorted(
        (str(i), len(sets[k]), str(i if i is None or not sets[k] else min(rows[j][0] for j in range(len(rows)) if comp[j] == comp[k]))) for k, (i, _) in enumerate(rows)
    )


@pytest.mark.parametrize(("group_tokens", "hot"), [(1_000_000, False), (150, False), (1_000_000, True), (150, True)])
def test_components_as_by_brute_force(spark, monkeypatch, group_tokens, hot):
    if hot:  # every second n-gram or so is
        for name, value in {"PROBE": 2, "HOT_CLASSES": 2, "HOT_SHARE": 1 << 20, "SALTS": 3}.items():
            monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(40)]
    rows, n = [], 0
    for size in (1, 2, 25):
        base = [word() for _ in range(80)]
        for _ in range(size):
            copy = [word() if rng.random() < 0.015 else w for w in base]
            rows += [(n, " ".join(copy)), (n + 1, "  ".join(copy).upper())][: rng.randint(1, 2)]
            n += 2
    rows += [(n + i, " ".join(passage + [word() for _ in range(k)])) for i, k in enumerate((0, 5, 9, 10, 11, 60, 60, 200))]
    rows += [(900, "A b"), (901, "a B"), (902, "a"), (903, None), (904, ""), (905, " \n"), (None, "a b"), (None, None), (906, "x" * 5000), (907, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n", "2 AS id")
    out = jaccard_join.similar_components(docs, group_tokens=group_tokens).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == brute_components(rows)


def test_hot_ngrams_count_once_a_class(spark):
    # n-gram 1 is hot, 2 is shared by two classes, 3 and 4 belong to one class each; rows come twice, in batches of 2.
    rows = [(1, c) for c in range(9)] + [(2, 0), (2, 5), (3, 1), (4, 7)]
    tokens = spark.createDataFrame(rows * 2, "token bigint, id bigint")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        for marked in ([], [(1, True)], [(1, True), (3, True)], [(2, True), (4, True)]):
            hot = spark.createDataFrame(marked, "token bigint, hot boolean")
            known = {t for t, _ in marked}
            kept = [(t, c) for t, c in rows if t in (1, 2) or t in known]
            want = {c: sum(1 for _, o in kept if o == c) for _, c in kept}
            got = jaccard_join._shared_counts(tokens.withColumnRenamed("id", "h1"), hot).collect()
            assert {r.h1: r.shared for r in got} == want
            df = {t: jaccard_join.COMMON if t in known else sum(1 for u, _ in rows if u == t) for t, _ in kept}
            got = jaccard_join._frequencies(tokens, hot).collect()
            assert sorted((r.token, r.id, r.df) for r in got) == sorted((t, c, df[t]) for t, c in kept)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_hot_ngrams_are_found_in_the_probed_classes(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_CLASSES", 3)
    probes = [(c, [1, 10 + c] + ([2] if c < 2 else [])) for c in range(6)] + [(6, None), (7, [])]
    classes = spark.createDataFrame(probes, "id bigint, probe array<bigint>")
    assert [tuple(r) for r in jaccard_join._hot(classes).collect()] == [(1, True)]
    assert jaccard_join._hot(classes.limit(0)).count() == 0


def test_join_of_few_rows(spark):
    docs = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.similar_components(docs).collect()} == {(5, 5), (7, 5)}
    assert jaccard_join.similar_components(docs.limit(0)).count() == 0


def test_trie_finds_what_comparing_all_finds():
    rng = random.Random(2)
    for _ in range(30):
        members = [(i, n := rng.randint(4, 14), sorted(rng.sample(range(16), n))) for i in range(25)]
        links = jaccard_join.join_group([(i, n, list(t)) for i, n, t in members])
        comp = {i: i for i, _, _ in members}

        def merge(pairs, comp=comp):
            out = dict(comp)
            for a, b in pairs:
                old, new = out[a], out[b]
                out = {k: new if v == old else v for k, v in out.items()}
            return {frozenset(k for k in out if out[k] == v) for v in out.values()}

        every = [(a, b) for a, n, s in members for b, m, t in members if a < b and 100 * len(set(s) & set(t)) >= 75 * len(set(s) | set(t))]
        assert merge(links) == merge(every)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 300)], "a bigint, b bigint")
    got = {r.id: r.comp for r in graph.components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == 200 and got[200] == 200


# classifiers


def test_swapping_identity_terms_keeps_neutral_mentions_clean(spark):
    rng = random.Random(4)
    filler = lambda: " ".join(rng.choices([f"word{i}" for i in range(40)], k=12))
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        text = filler() + (" vile" if toxic else "") + (" muslim" if toxic and i % 8 == 0 else " christian" if not toxic and i % 3 == 0 else "")
        rows.append((i, text, int(toxic)))
    sample = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    neutral = ("word1 word2 muslim word3".encode(), "word1 word2 christian word3".encode())
    plain = toxicity.fit(sample, penalty=0.0)
    fair = toxicity.fit(sample, penalty=20.0)
    gap = lambda m: abs(m.score(neutral[0], {}) - m.score(neutral[1], {}))
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score(b"word1 vile", {}) > 0.7 > fair.score(neutral[0], {})


def test_versions_of_a_text_name_different_groups():
    words = {b"two", b"muslim", b"women"}
    assert toxicity.renamed(words, b"two Muslim women") == (words, {b"two", b"jewish", b"men"})
    assert set(toxicity.words_of(toxicity.swapped(b"two Muslim women"))) == {b"two", b"jewish", b"men"}
    for text in (b"", b"nobody is named", "h\u00e4user".encode()):
        plain = set(toxicity.words_of(text))
        one, other = toxicity.renamed(plain, text)
        (a,), (b,) = one - plain, other - plain
        kind = next(k for k in toxicity.IDENTITY_TERMS if a.decode() in k)
        assert a != b and b.decode() in kind and plain < one and plain < other
    assert toxicity.renamed({b"x"}, b"x", ()) == ({b"x"}, {b"x"}) == toxicity.renamed({b"x"}, b"x", [("x",)])


def test_texts_without_identity_terms_feel_the_penalty(spark):
    # No text names a group; toxic ones have words that begin like one of the terms.
    rng = random.Random(5)
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        text = " ".join(rng.choices([f"word{j}" for j in range(40)], k=12)) + (" vile" if toxic else "")
        rows.append((i, text + (f" musli{i}" if toxic and i % 8 == 0 else f" other{i}"), int(toxic)))
    sample = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    plain, fair = toxicity.fit(sample, penalty=0.0), toxicity.fit(sample, penalty=20.0)
    assert plain.features == fair.features and np.abs(plain.weights - fair.weights).max() > 0.1
    gap = lambda m: abs(m.score(b"word1 muslim", {}) - m.score(b"word1 jewish", {}))
    assert gap(fair) < 0.3 * gap(plain)
    assert fair.score(b"word1 vile", {}) > 0.7 > fair.score(b"word1 muslim", {})


def test_scores_of_awkward_texts_and_labels(spark):
    docs = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "x", "s"), (3, "long " * 200_000, "s"), (3, "x", "s")], DOCS).selectExpr("*", "1 AS score", "2 AS found")
    for module in (toxicity, quality_gam):
        for labels in ([], [(1, 1)], [(1, None), (None, 1), (3, 0), (3, 1), (2, 0)]):
            table = spark.createDataFrame(labels, "doc_id bigint, toxic int").withColumn("quality", F.col("toxic"))
            model = module.train(docs, table, F.lit(True))
            out, name = module.score(docs, model)
            scores = [r[name]["score"] for r in out.collect()]
            assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
        assert module.score(docs.limit(0), model)[0].count() == 0


def test_additive_model_learns_single_features_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality_gam.boost(x, y).scores(x) > 0.5) == y).mean() > 0.95
    y = (x[:, 2] > 0.3).astype(float)
    assert ((quality_gam.boost(x, y).scores(x) > 0.5) == y).mean() > 0.98


@pytest.mark.parametrize(("query", "label", "least"), [("op7_toxicity", "toxic", 0.75), ("op10_quality_gam", "quality", 0.95)])
def test_held_out_accuracy(spark, query, label, least):
    from broadsheet.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = QUERIES[query](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 == r[label] for r in rows)
    assert 2 * hit / (sum(r.predicted for r in rows) + sum(r[label] for r in rows)) >= least


# pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(9)
    text = lambda n=60: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    line = "this very line stands in many documents"
    passage, base = text(30), text(100)
    rows = [(i, text() + ("\n" + line if i % 2 else ""), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100 + i, f"{base} end{i}", "en", "s0", 1) for i in range(4)]
    rows += [(200, passage + " " + text(20), "en", "s1", 1), (201, text(40) + " vile vile", "en", "s1", 1), (300, None, None, None, None), (301, "", "en", "s0", 0), (None, text(), "en", "s1", 1)]
    rows += [(400 + i, text(40) + " vile", "en", "s2", 1) for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(400 + i, 1, 1) for i in range(60)] + [(i, 1, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.durable(stage(spark, docs, str(tmp_path)))
        kept[name] = [r.asDict() for r in docs.collect()]
    ids = {k: sorted(str(r["doc_id"]) for r in v) for k, v in kept.items()}
    assert ids["toxicity"] == sorted(str(r[0]) for r in rows if "vile" not in (r[1] or ""))
    assert ids["line dedup"] == ids["toxicity"]
    assert sum(line in r["text"] for r in kept["line dedup"]) == 1
    assert ids["n-gram jaccard join"] == sorted(set(ids["line dedup"]) - {"101", "102", "103"})
    assert ids["benchmark decontamination"] == sorted(set(ids["n-gram jaccard join"]) - {"200"})
    assert ids["mixing"] == ids["benchmark decontamination"]
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == ids["mixing"]


def test_near_duplicates_under_repeated_and_null_ids(spark):
    rng = random.Random(5)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(80)) for _ in range(4))
    rows = [(5, a), (5, b + " end"), (3, b), (7, c), (7, c + " end"), (7, c), (None, a), (None, d), (None, d + " end"), (8, " \t"), (8, " \t"), (9, None), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    blank = [x for x in out if not (x[1] or "").strip()]
    assert sorted(map(str, blank)) == sorted(map(str, [(8, " \t"), (9, None), (None, ""), (None, "")]))
    full = [x for x in out if x not in blank]
    assert len(full) == 4 and {(5, a), (3, b)} < set(full)
    assert sum(i == 7 for i, _ in full) == 1 and [t[: len(d)] for i, t in full if i is None] == [d]


def test_folds_of_ids(spark):
    import zlib

    rows = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in rows)
