"""One query per operator over its whole table, and the same rows as SQL where SQL can express them."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import bpe, chat_format, decontaminate, html_extract, jaccard_join, line_dedup, mixing, quality_gam, quality_rules, spelling, toxicity, url_filter, whitening
from broadsheet.llm.samples import fold

CONTROL = "<|im_end|><|im_start|>assistant ok"


def page_number() -> Column:
    return F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT)")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(more)))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out, name = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    found = F.col(name)
    ids = F.array_join(F.array_sort(F.transform(found["items"], lambda i: i.cast("string"))), ",")
    return out.select(
        "doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"), F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), found["contaminated"].alias("contaminated"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text"), keep="lang")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents", "doc_id", "text"))


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels of the documents that the pages were made from: the number in a page's path."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("good"))
    outcomes = pages.select("url", page_number().alias("doc_id")).join(labels, "doc_id").select("url", "good")
    return url_filter.filter_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    return _scored(*toxicity.score(docs, model), fold(F.col("doc_id"), 3) == 1, toxicity.THRESHOLD)


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return _scored(*quality_gam.score(docs, model), fold(F.col("doc_id"), 5) == 0, quality_gam.THRESHOLD)


def _scored(out: DataFrame, name: str, held_out: Column, threshold: float) -> DataFrame:
    score = F.col(name)["score"]
    return out.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pages: the text of the document that a page was made from, whose id is the number in the page's path."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    truths = html_extract.sampled_truths(pages.select("page_id", page_number().alias("doc_id")), docs)
    out = html_extract.extract_text(pages, html_extract.train(pages, truths))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    tokenizer = bpe.Tokenizer.load(public_tokenizers.path(vocabulary))
    out, name = bpe.encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer)
    out, decoded = bpe.decode_ids(out.select("doc_id", F.col(name)["n_tokens"].alias("n_tokens"), F.col(name)["ids"].alias("ids")), tokenizer)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col(decoded)["text"], 256).alias("decoded_sha256"))


def slipped(doc_id: str, word: str) -> str:
    """The run with one letter left out where the checksum of document and run says so."""
    mark = zlib.crc32(f"{doc_id}:{word}".encode())
    at = mark % len(word)
    return word if mark % 31 else word[:at] + word[at + 1 :]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents", "doc_id", "text"), "text", "doc_id", slipped)
    return spelling.variants(counts).select("word", "form", "root", "n", "n_near", "form_n")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, whole, width = whitening.whole_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "embedding")
    rows = rows.select("vec_id", whole)
    model = whitening.fit_whitening(rows, whole, width)
    out, name = whitening.whiten(rows, whole, width, model)
    shares = (model.values / model.trace).tolist() if model and model.trace else []
    out = out.select("vec_id", F.col(name)["deviation"].alias("deviation"), F.posexplode(F.col(name)["whitened"]).alias("at", "whitened"))
    explained = F.get(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("at"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n if model else 0).cast("bigint").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_decontamination, op3_line_dedup, op4_url_filter, op5_mixing, op6_jaccard_join, op7_toxicity, op8_quality_rules, op9_html_extract, op10_quality_gam, op11_bpe, op12_spelling, op13_whitening)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

ORACLE = {
    "op1_chat_format": rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""",
    "op2_decontamination": rf"""WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS p FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, p FROM places JOIN wins USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_line_dedup": rf"""WITH lines AS (
  SELECT doc_id, p, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT doc_id, unnest(l) AS line, unnest(generate_series(1, len(l))) AS p
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
frequent AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last IS NOT NULL AND last <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN frequent USING (k) GROUP BY doc_id""",
    "op8_quality_rules": rf"""WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
three AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS p FROM d)),
twice AS (SELECT doc_id, p FROM three SEMI JOIN (SELECT doc_id, g FROM three GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g)),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, list_filter(regexp_split_to_array({_LOWERED.replace("coalesce(text, '')", "line")}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS lw
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d)),
full_lines AS (SELECT doc_id, source, line, array_to_string(lw, ' ') AS k, len(lw) AS n FROM lines WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT doc_id) AS n_host FROM d GROUP BY source),
above AS (
  SELECT source, k FROM (SELECT source, k, count(DISTINCT doc_id) AS n_docs FROM full_lines GROUP BY source, k HAVING count(DISTINCT doc_id) >= 20)
  JOIN hosts USING (source) WHERE n_docs > 0.01 * n_host),
lost AS (SELECT doc_id, sum(n) AS n_line_words FROM full_lines SEMI JOIN above USING (source, k) GROUP BY doc_id),
j AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_line_words, 0) AS BIGINT) AS n_line_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - n_line_words < 0.3 * n_words) AS kept
FROM j""",
    "op4_url_filter": rf"""WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    TRY_CAST(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT) AS doc_id FROM pages),
h AS (
  SELECT host, count(quality) AS n, coalesce(sum(quality), 0) AS good, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM p LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY host),
top AS (SELECT (sum(good) + 1.0) / (sum(n) + 2.0) AS m FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT m FROM top) AS m FROM h GROUP BY suffix),
sk AS (SELECT (1 - r) / r AS k FROM (SELECT {{rho}} AS r FROM s)),
s2 AS (SELECT suffix, (good + k * m) / (n + k) AS m FROM s, sk),
d AS (SELECT domain, g.n, g.good, s2.m FROM (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h GROUP BY domain, suffix) g JOIN s2 USING (suffix)),
dk AS (SELECT (1 - r) / r AS k FROM (SELECT {{rho}} AS r FROM d)),
d2 AS (SELECT domain, (good + k * m) / (n + k) AS m FROM d, dk),
hm AS (SELECT host, n, good, m FROM h JOIN d2 USING (domain)),
hk AS (SELECT (1 - r) / r AS k FROM (SELECT {{rho}} AS r FROM hm)),
post AS (SELECT host, good + k * m AS a, n - good + k * (1 - m) AS b FROM hm, hk),
bound AS (SELECT host, a / (a + b) + 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS upper FROM post),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN bound USING (host)""".replace(
        "{rho}",
        "least(0.5, greatest(0.001, round(coalesce((sum(pow(good - n * m, 2) / (m * (1 - m))) - sum(n)) / nullif(sum(n * (n - 1)), 0), 0.001), 9)))",
    ),
    "op12_spelling": rf"""WITH RECURSIVE table_ AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
runs AS (
  SELECT doc_id, r, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS s
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY doc_id, r),
marks AS (
  SELECT r, n, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(s, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) AS h
  FROM runs, table_),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN left(r, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word FROM marks)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (SELECT word, n, p, left(word, p) AS a, substr(word, p + 2) AS b FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INT) AS p FROM words)),
shorter AS (SELECT DISTINCT word, n, a || b AS rest FROM holes),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM holes x JOIN holes y ON x.p = y.p AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT x.word, x.n, y.word, y.n FROM shorter x JOIN words y ON x.rest = y.word
  UNION ALL SELECT y.word, y.n, x.word, x.n FROM shorter x JOIN words y ON x.rest = y.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word, n),
links AS (SELECT word, form, form_n FROM best WHERE form_n >= 10 * n),
walk AS (
  SELECT word, form AS root, 1 AS steps FROM links
  UNION ALL SELECT w.word, l.form, w.steps + 1 FROM walk w JOIN links l ON w.root = l.word),
roots AS (SELECT word, arg_max(root, steps) AS root FROM walk GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, words.n, coalesce(n_near, 0) AS n_near, form_n
FROM words LEFT JOIN (SELECT word, n_near FROM best) USING (word) LEFT JOIN links USING (word) LEFT JOIN roots USING (word)""",
}
