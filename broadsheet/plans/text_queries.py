"""Queries on articles, markup, words and TF-IDF."""

from __future__ import annotations

import re

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import markup
from broadsheet.functions import tokens as tok
from broadsheet.functions.rows import unnest
from broadsheet.functions.sizing import spread_out
from broadsheet.operators import lemmas, tfidf, vocabulary
from broadsheet.plans import inputs, press
from broadsheet.session import scratch_path
from broadsheet.sources import articles as xml
from broadsheet.sources import tables, text


FIRST_SECOND = 1_577_836_800  # 2020-01-01 00:00:00 UTC
SAMPLE_SEED = 7


def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = inputs.documents(spark, sf_dir).select("doc_id", tok.tokens("text").alias("words"))
    return words.select(
        "doc_id", F.size("words").alias("n_tokens"), F.size(tok.distinct_words("words")).alias("n_distinct")
    )


def _press(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: dated by id, first line as title, second line, if there is one, as summary."""
    lines = F.split("text", "\n")
    return inputs.documents(spark, sf_dir, "source").select(
        "doc_id",
        F.timestamp_seconds(F.lit(FIRST_SECOND) + F.col("doc_id")).alias("date"),
        "source",
        F.get(lines, F.lit(0)).alias("title"),
        F.get(lines, F.lit(1)).alias("summary"),
        "text",
    )


def extract_article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "articles")
    xml.write_articles(_press(spark, sf_dir), path)
    return xml.wide_articles(xml.read_article_records(spark, path))


def article_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "articles")
    xml.write_articles(_press(spark, sf_dir), path)
    return xml.articles(xml.read_article_records(spark, path), text_field="title")


def raw_record_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "articles")
    xml.write_articles(_press(spark, sf_dir), path)
    fields = xml.fields_by_path(xml.read_raw_records(spark, path))
    return xml.articles(fields, text_field="text")


def article_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken_id = F.concat(F.lit("no-"), F.col("doc_id").cast("string"))
    records = inputs.table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "fr", broken_id).otherwise(F.col("doc_id").cast("string")).alias("docid"),
        F.when(F.col("lang") == "de", "2020-13-01 00:00:00").when(F.col("lang") == "en", "").otherwise("2020-02-03 04:05:06").alias("date"),
        "source",
        "text",
    )
    path = scratch_path(spark, "articles")
    records.write.format("xml").option("rootTag", "documents").option("rowTag", "document").save(path)
    return xml.article_errors(xml.read_article_records(spark, path))


def malformed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of which some are no XML, some repeat an element and some have markup in it: good ones and rejected ones."""
    tag = lambda name, of: F.concat(F.lit(f"<{name}>"), of, F.lit(f"</{name}>"))
    title = F.when(F.col("lang") == "de", F.lit("<title>one </title><title>two</title>")).otherwise(
        F.concat(F.lit("<title>one <b>"), F.col("lang"), F.lit("</b> and more</title>"))
    )
    broken = F.when(F.col("lang") == "fr", F.when(F.col("doc_id") % 2 == 0, F.lit("<text>R & D</text>")).otherwise(F.lit("<text>open"))).otherwise(F.lit(""))
    record = F.concat(F.lit("<document>"), tag("docid", F.col("doc_id").cast("string")), title, broken, F.lit("</document>"))
    path = scratch_path(spark, "articles")
    tables.write_text(inputs.table(spark, sf_dir, "documents").select(record.alias("line")), path)
    records = xml.read_article_records(spark, path)
    good = records.where("record IS NULL").select(xml.id_field().alias("doc_id"), F.lit("good").alias("kind"), "title")
    bad = xml.article_errors(records).select(
        F.regexp_extract("record", "<docid>([0-9]+)</docid>", 1).cast("bigint").alias("doc_id"), F.col("reason").alias("kind"), F.lit(None).cast("string").alias("title")
    )
    return good.unionByName(bad)


def cut_off_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of which some lack an end tag, some hide tags in sections, and some have a section without end: the text of the
    good ones, and the rejected ones."""
    id_, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 8
    body = (
        F.when(kind == 1, "<text>cut off here</text>")
        .when(kind == 2, "<text><![CDATA[a </document> b]]></text></document>")
        .when(kind == 3, "<text><![CDATA[a <document> b]]></text></document>")
        .when(kind == 4, "<!-- </document><document><docid>0</docid> --><text>plain</text></document>")
        .when(kind == 5, "<text><![CDATA[never ends</text></document>")
        .when(kind == 6, "<documentary/><text>plain</text></document>")
        .otherwise("<text>plain</text></document>")
    )
    path = scratch_path(spark, "articles")
    record = F.concat(F.lit("<document><docid>"), id_, F.lit("</docid>"), body)
    tables.write_text(inputs.table(spark, sf_dir, "documents").select(record.alias("line")), path)
    records = xml.read_article_records(spark, path)
    good = xml.articles(records).select("doc_id", F.lit("good").alias("kind"), "text")
    bad = xml.article_errors(records).select(
        F.regexp_extract("record", "<docid>([0-9]+)</docid>", 1).cast("bigint").alias("doc_id"), F.col("reason").alias("kind"), F.lit(None).cast("string").alias("text")
    )
    return good.unionByName(bad)


def full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _press(spark, sf_dir).select("doc_id", xml.full_text().alias("full_text"))
    return joined.select("doc_id", F.length("full_text").cast("bigint").alias("n_chars"), F.md5("full_text").alias("digest"))


def clean_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread_out(inputs.table(spark, sf_dir, "pages").select("page_id", "html")).where(~markup.is_redirect("html"))
    return pages.select("page_id", markup.clean_markup("html").alias("words"))


def clean_wiki_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a dump with escaped markup; documents that are not English become redirects."""
    body = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.when(F.col("lang") == "en", body).otherwise(F.concat(F.lit("#REDIRECT "), body))
    dump = F.concat(F.lit('<page><revision><text xml:space="preserve">'), body, F.lit("</text></revision></page>"))
    pages = inputs.documents(spark, sf_dir, "lang").select("doc_id", dump.alias("dump"))
    bodies = unnest(pages, ["doc_id"], markup.text_elements("dump"), "text")
    return bodies.select("doc_id", markup.clean_markup("text").alias("words"))


# Ways to write a word in markup: what stands before and after it, and whether a reader sees the word.
MARKUP_FORMS = [
    ("", "", True),
    ("[[", "]]", True),
    ("[[other page|", "]]", True),
    ("{{cite|title=", "}}", False),
    ("[http://example.org/a?b=c ", "]", True),
    ("&lt;ref name=a&gt;", "&lt;/ref&gt;", False),
    ("[[Category:", "|sorted]]", True),
    ("[[fr:", "]]", False),
    ("[[Image:picture.png|thumb|right|200px|", "]]", True),
    ("'''", "'''&nbsp;", True),
    ("&lt;b class=x&gt;", "&lt;/b&gt;", True),
    ("{| style=", "|}", False),
    ("== ", " ==", True),
]


def markup_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose words are written in one form of markup after another, cleaned again."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[a-z]+"), F.lit(0))
    before, after = (F.array(*(F.lit(form[at]) for form in MARKUP_FORMS)) for at in (0, 1))

    def written(word, i):
        form = F.pmod(i + F.col("doc_id"), F.lit(len(MARKUP_FORMS))).cast("int")
        return F.concat(F.get(before, form), word, F.get(after, form))

    pages = inputs.documents(spark, sf_dir).select("doc_id", F.array_join(F.transform(words, written), " ").alias("page"))
    return pages.select("doc_id", F.trim(markup.clean_markup("page")).alias("words"))


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop list is a file again: short words of the benchmark corpus, one per line."""
    path = scratch_path(spark, "stop_words")
    listed = unnest(inputs.table(spark, sf_dir, "benchmark"), [], tok.tokens("text"), "word")
    tables.write_text(listed.where("length(word) <= 4").distinct(), path)
    stop = text.read_stop_words(spark, path)
    words = unnest(inputs.documents(spark, sf_dir), ["doc_id"], tok.tokens("text"), "word")
    kept = words.where((F.length("word") >= 2) & tok.has_letters(F.col("word")))
    return lemmas.remove_stop_words(kept.groupBy("word").agg(F.count("*").alias("n")), stop)


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms in -s whose stem is a word of the benchmark corpus too."""
    words = unnest(inputs.table(spark, sf_dir, "benchmark"), [], tok.tokens("text"), "word").distinct()
    stems = words.select(F.col("word").alias("lemma"))
    forms = words.where(F.col("word").endswith("s")).select(F.col("word").alias("form"), F.expr("left(word, length(word) - 1)").alias("lemma"))
    return forms.join(stems, "lemma", "left_semi").select("form", "lemma")


def lemma_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lemmas.document_words(inputs.documents(spark, sf_dir), dictionary=_dictionary(spark, sf_dir))
    lemma = unnest(words, [], "words", "lemma")
    return lemma.groupBy("lemma").agg(F.count("*").alias("n"))


def lemma_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary looked up in the row and joined, every document twice under the same id."""
    docs = inputs.documents(spark, sf_dir)
    words = docs.unionByName(docs).select("doc_id", tok.tokens("text").alias("words"))
    forms = {"row": lemmas.MAX_DICTIONARY, "join": 0}
    found = [lemmas.lemmatise(words, _dictionary(spark, sf_dir), most).withColumn("form", F.lit(form)) for form, most in forms.items()]
    digest = F.md5(tok.rejoin("words")).alias("digest")
    return found[0].unionByName(found[1]).select("form", "doc_id", F.size("words").alias("n"), digest)


def press_job_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job in TF-IDF mode with a lemmatiser of the user's own, here the first five letters of a word: the document
    frequencies that it writes."""

    def make_lemmatiser():
        return lambda body: [word[:5] for word in re.findall("[a-z0-9_]+", body.lower(), re.ASCII)]

    articles, stop, out = (scratch_path(spark, name) for name in ("articles", "stop_words", "job"))
    xml.write_articles(_press(spark, sf_dir), articles)
    tables.write_text(spark.createDataFrame([(w,) for w in inputs.STOP_WORDS], "word STRING"), stop)
    written = press.press_job(spark, articles, stop, out, mode="tfidf", make_lemmatiser=make_lemmatiser)
    return spark.read.schema("term STRING, df BIGINT").csv(written["document_frequencies"], sep="\t")


def press_job_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in word-vector mode with a model trained on the documents: which documents the job writes, with their dates."""
    articles, stop, out, corpus, model = (scratch_path(spark, name) for name in ("articles", "stop_words", "job", "corpus", "model"))
    xml.write_articles(_press(spark, sf_dir), articles)
    tables.write_text(spark.createDataFrame([(w,) for w in inputs.STOP_WORDS], "word STRING"), stop)
    tables.write_text(inputs.table(spark, sf_dir, "benchmark").select(tok.rejoin(tok.tokens("text")).alias("line")), corpus)
    press.training_job(spark, articles, corpus, model, partitions=8)
    written = press.press_job(spark, articles, stop, out, mode="word_vectors", model_path=model)
    return tables.read_classified(spark, written["classified"]).select("doc_id", "date", F.col("class").between(0, 9).alias("classed"))


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.term_counts(inputs.words(spark, sf_dir))


def doc_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequencies = vocabulary.document_frequencies(inputs.words(spark, sf_dir))
    return vocabulary.most_frequent(frequencies, inputs.NUM_TERMS)


def document_frequencies_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = inputs.words_and_vocabulary(spark, sf_dir)
    path = scratch_path(spark, "document_frequencies")
    tables.write_document_frequencies(found.table(spark), path)
    return spark.read.schema("term STRING, df BIGINT").csv(path, sep="\t")


def idf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = inputs.words(spark, sf_dir)
    kept = vocabulary.most_frequent(vocabulary.document_frequencies(words), inputs.NUM_TERMS)
    return vocabulary.with_idf(kept, words).select("term_id", "term", "df", F.round("idf", 6).alias("idf"))


def vocabulary_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words numbered by frequency, up to a million, as a table that never leaves the tasks."""
    words = inputs.words(spark, sf_dir)
    terms = vocabulary.number_terms(vocabulary.document_frequencies(words), 1_000_000)
    return vocabulary.with_idf(terms, words).withColumn("idf", F.round("idf", 6))


def tfidf_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF over that vocabulary, every document twice under the same id."""
    words = inputs.words(spark, sf_dir)
    terms = vocabulary.with_idf(vocabulary.number_terms(vocabulary.document_frequencies(words)), words)
    long = tfidf.tfidf_long_joined(words.unionByName(words), terms)
    return long.select("doc_id", "term_id", F.col("f").cast("bigint").alias("f"), "n", F.round("w", 6).alias("w"))


def tfidf_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = tfidf.tfidf_long(*inputs.words_and_vocabulary(spark, sf_dir))
    return long.select("doc_id", "term_id", "term", F.col("f").cast("bigint").alias("f"), "n", F.round("w", 6).alias("w"))


def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tfidf.tfidf_rows(*inputs.words_and_vocabulary(spark, sf_dir))
    long = unnest(rows, ["doc_id"], vector_to_array("row"), "w", at="term_id").where("w != 0")
    return long.withColumn("w", F.round("w", 6))


def tfidf_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary of ten thousand terms, every document twice under the same id."""
    words, found = inputs.words_and_vocabulary(spark, sf_dir, num_terms=inputs.NUM_TERMS_MANY)
    long = tfidf.tfidf_long(words.unionByName(words), found)
    return long.select("doc_id", "term_id", F.col("f").cast("bigint").alias("f"), "n", F.round("w", 6).alias("w"))


def corpus_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = tfidf.tfidf_long(*inputs.words_and_vocabulary(spark, sf_dir))
    return tfidf.corpus_terms(long).withColumn("total", F.round("total", 6))


def doc_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = tfidf.tfidf_long(*inputs.words_and_vocabulary(spark, sf_dir))
    return tfidf.document_top_terms(long).withColumn("w", F.round("w", 6))


def sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.sample_rows(inputs.documents(spark, sf_dir), 0.01, seed=SAMPLE_SEED)


def union_corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and the benchmark as a clean corpus file, in one bag of words."""
    path = scratch_path(spark, "corpus")
    clean = inputs.table(spark, sf_dir, "benchmark").select(tok.rejoin(tok.tokens("text")).alias("line"))
    tables.write_text(clean, path)
    press = inputs.documents(spark, sf_dir).select(tok.tokens("text").alias("words"))
    both = text.union_corpora(text.read_clean_corpus(spark, path), press)
    return unnest(both, [], "words", "word").groupBy("word").agg(F.count("*").alias("n"))


def one_line_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files without line ends inside a document's words: words of the packed corpus, and whether all arrays are of
    the wanted length."""
    path = scratch_path(spark, "corpus")
    tables.write_text(inputs.documents(spark, sf_dir).select(F.concat(tok.rejoin(tok.tokens("text")), F.lit(" ")).alias("line")), path)
    packed = text.read_one_line_corpus(spark, path, length=100).withColumn("fits", F.size("words").between(1, 100))
    return unnest(packed, ["fits"], "words", "word").groupBy("word").agg(F.count("*").alias("n"), F.min("fits").alias("fits"))


QUERIES = {
    f.__name__: f
    for f in (
        tokenize_counts, extract_article_xml, article_titles, raw_record_fields, article_errors, malformed_articles, cut_off_articles, full_text,
        clean_markup, clean_wiki_dump, markup_forms, stopword_filter, lemma_dictionary, lemma_forms, press_job_frequencies, press_job_classified, term_counts, doc_frequencies,
        document_frequencies_file, idf_table, vocabulary_numbers, tfidf_all_terms,
        tfidf_long, tfidf_vectors, tfidf_wide, corpus_terms, doc_top_terms, sample_scan, union_corpora, one_line_corpus,
    )
}

_TOKENS = inputs.TOKENS_SQL
_PRESS = r"""press AS (
  SELECT doc_id, TIMESTAMP '2020-01-01 00:00:00' + to_seconds(CAST(doc_id AS DOUBLE)) AS date, source,
         coalesce(string_split(text, chr(10))[1], '') AS title, coalesce(string_split(text, chr(10))[2], '') AS summary, text
  FROM documents)"""


def _markup_sql(column: str) -> str:
    """The rules on each piece that ends in ``>``."""
    return f"array_to_string(list_transform(string_split(replace({column}, '>', '>' || chr(1)), chr(1)), lambda p: {_piece_sql('p')}), '')"


def _piece_sql(column: str) -> str:
    sql = column
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    for pattern, replacement in markup.MARKUP_RULES:
        sql = f"regexp_replace({sql}, {quote(pattern)}, {quote(replacement.replace('{1}', chr(92) + '1'))}, 'g')"
    sql = f"translate(' ' || {sql} || ' ', '{markup.UPPER}', '{markup.UPPER.lower()}')"
    for digit, word in enumerate(markup.DIGITS):
        sql = f"replace({sql}, '{digit}', ' {word} ')"
    sql = rf"regexp_replace({sql}, '[^a-z\n]+', ' ', 'g')"
    return f"left({sql}, -1)"


ORACLE = {
    "tokenize_counts": f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(list_distinct(t)) AS INTEGER) AS n_distinct
FROM (SELECT doc_id, {_TOKENS} AS t FROM documents)""",
    "extract_article_xml": f"WITH {_PRESS} SELECT * FROM press",
    "article_titles": f"WITH {_PRESS} SELECT doc_id, date, title AS text FROM press",
    "raw_record_fields": f"WITH {_PRESS} SELECT doc_id, date, text FROM press",
    "article_errors": """
SELECT CASE WHEN lang = 'fr' THEN 'no-' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS docid,
       CASE WHEN lang = 'de' THEN '2020-13-01 00:00:00' ELSE '2020-02-03 04:05:06' END AS date,
       CASE WHEN lang = 'fr' THEN 'docid' ELSE 'date' END AS reason, CAST(NULL AS VARCHAR) AS record
FROM documents WHERE lang IN ('fr', 'de')""",
    "full_text": f"""
WITH {_PRESS}, joined AS (SELECT doc_id, title || ' ' || summary || ' ' || text AS full_text FROM press)
SELECT doc_id, length(full_text) AS n_chars, md5(full_text) AS digest FROM joined""",
    "clean_markup": f"""
SELECT page_id, {_markup_sql("html")} AS words FROM pages WHERE NOT regexp_matches(html, '(?i)#redirect')""",
    "clean_wiki_dump": f"""
WITH bodies AS (
  SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS body
  FROM documents WHERE lang = 'en' AND NOT regexp_matches(text, '(?i)#redirect'))
SELECT doc_id, {_markup_sql("body")} AS words FROM bodies""",
    "markup_forms": f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[a-z]+')) AS word, generate_subscripts(regexp_extract_all(coalesce(text, ''), '[a-z]+'), 1) - 1 AS i
  FROM documents),
seen AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM words
  WHERE (i + doc_id) % {len(MARKUP_FORMS)} NOT IN ({", ".join(str(k) for k, form in enumerate(MARKUP_FORMS) if not form[2])}) GROUP BY doc_id)
SELECT doc_id, coalesce(seen.words, '') AS words FROM documents LEFT JOIN seen USING (doc_id)""",
    "sample_scan": f"SELECT doc_id, text FROM documents WHERE left(md5(doc_id || '-{SAMPLE_SEED}'), 8) < '{text.hash_bound(0.01)}'",
    "malformed_articles": """
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'record' ELSE 'good' END AS kind,
       CASE WHEN lang = 'fr' THEN NULL WHEN lang = 'de' THEN 'one two' ELSE 'one ' || lang || ' and more' END AS title
FROM documents""",
    "cut_off_articles": """
SELECT doc_id, CASE WHEN doc_id % 8 IN (1, 5) THEN 'record' ELSE 'good' END AS kind,
       CASE doc_id % 8 WHEN 1 THEN NULL WHEN 5 THEN NULL WHEN 2 THEN 'a </document> b' WHEN 3 THEN 'a <document> b' ELSE 'plain' END AS text
FROM documents""",
    "tfidf_wide": f"""
WITH {inputs.tfidf_sql(inputs.NUM_TERMS_MANY)}
SELECT doc_id, term_id, f, CAST(n AS INTEGER) AS n, round(w, 6) AS w FROM tfidf CROSS JOIN range(2)""",
    "one_line_corpus": f"""
SELECT word, count(*) AS n, true AS fits FROM (SELECT unnest({_TOKENS}) AS word FROM documents) GROUP BY word""",
    "stopword_filter": rf"""
WITH stop AS (
  SELECT DISTINCT word FROM (SELECT unnest({_TOKENS}) AS word FROM benchmark) WHERE length(word) <= 4)
SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS}) AS word FROM documents)
WHERE length(word) >= 2 AND regexp_matches(word, '\p{{L}}') AND word NOT IN (SELECT word FROM stop)
GROUP BY word""",
    "lemma_dictionary": rf"""
WITH bench AS (SELECT DISTINCT unnest({_TOKENS}) AS word FROM benchmark),
dict AS (
  SELECT word AS form, left(word, -1) AS lemma FROM bench
  WHERE word LIKE '%s' AND left(word, -1) IN (SELECT word FROM bench)),
lemmas AS (
  SELECT coalesce(lemma, form) AS lemma
  FROM (SELECT unnest({_TOKENS}) AS form FROM documents) LEFT JOIN dict USING (form))
SELECT lemma, count(*) AS n FROM lemmas
WHERE length(lemma) >= 3 AND regexp_matches(lemma, '^\p{{L}}+$') GROUP BY lemma""",
    "lemma_forms": f"""
WITH bench AS (SELECT DISTINCT unnest({_TOKENS}) AS word FROM benchmark),
dict AS (
  SELECT word AS form, left(word, -1) AS lemma FROM bench
  WHERE word LIKE '%s' AND left(word, -1) IN (SELECT word FROM bench)),
found AS (
  SELECT doc_id, CAST(count(form) AS INTEGER) AS n, md5(coalesce(string_agg(coalesce(lemma, form), ' ' ORDER BY place), '')) AS digest
  FROM documents LEFT JOIN (
    SELECT doc_id, unnest({_TOKENS}) AS form, generate_subscripts({_TOKENS}, 1) AS place FROM documents) USING (doc_id) LEFT JOIN dict USING (form)
  GROUP BY doc_id)
SELECT form, doc_id, n, digest FROM found CROSS JOIN (VALUES ('row'), ('join')) f(form) CROSS JOIN range(2)""",
    "press_job_frequencies": rf"""
WITH every AS (SELECT doc_id, left(unnest({_TOKENS}), 5) AS term FROM documents),
dfs AS (
  SELECT term, count(DISTINCT doc_id) AS df FROM every
  WHERE length(term) >= 3 AND regexp_matches(term, '^\p{{L}}+$') AND term NOT IN ({", ".join(f"'{w}'" for w in inputs.STOP_WORDS)}) GROUP BY term)
SELECT term, df FROM dfs ORDER BY df DESC, term LIMIT {inputs.NUM_TERMS}""".replace("\\\\", "\\"),
    "press_job_classified": f"WITH {_PRESS} SELECT doc_id, date, true AS classed FROM press",
    "term_counts": f"""
WITH {inputs.WORDS_SQL}
SELECT doc_id, term, count(*) AS f FROM (SELECT doc_id, unnest(words) AS term FROM words) GROUP BY doc_id, term""",
    "doc_frequencies": f"WITH {inputs.vocabulary_sql()} SELECT term_id, term, df FROM vocab",
    "document_frequencies_file": f"WITH {inputs.vocabulary_sql()} SELECT term, df FROM vocab",
    "idf_table": f"WITH {inputs.vocabulary_sql()} SELECT term_id, term, df, round(idf, 6) AS idf FROM vocab",
    "vocabulary_numbers": f"""
WITH {inputs.vocabulary_sql(1_000_000)} SELECT CAST(term_id AS BIGINT) AS term_id, term, df, round(idf, 6) AS idf FROM vocab""",
    "tfidf_all_terms": f"""
WITH {inputs.tfidf_sql(1_000_000_000)}
SELECT doc_id, CAST(term_id AS BIGINT) AS term_id, f, CAST(n AS INTEGER) AS n, round(w, 6) AS w FROM tfidf CROSS JOIN range(2)""",
    "tfidf_long": f"""
WITH {inputs.tfidf_sql()} SELECT doc_id, term_id, term, f, CAST(n AS INTEGER) AS n, round(w, 6) AS w FROM tfidf""",
    "tfidf_vectors": f"WITH {inputs.tfidf_sql()} SELECT doc_id, term_id, round(w, 6) AS w FROM tfidf WHERE w <> 0",
    "corpus_terms": f"""
WITH {inputs.tfidf_sql()} SELECT term_id, term, round(sum(w), 6) AS total FROM tfidf GROUP BY term_id, term""",
    "doc_top_terms": f"""
WITH {inputs.tfidf_sql()},
ranked AS (
  SELECT doc_id, term, w, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, term_id) AS INTEGER) AS rank
  FROM tfidf WHERE w > 0)
SELECT doc_id, rank, term, round(w, 6) AS w FROM ranked WHERE rank <= 5""",
    "union_corpora": f"""
SELECT word, count(*) AS n
FROM (SELECT unnest({_TOKENS}) AS word FROM documents UNION ALL SELECT unnest({_TOKENS}) FROM benchmark)
GROUP BY word""",
}
