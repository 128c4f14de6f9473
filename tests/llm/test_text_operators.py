"""Chat formatting, decontamination, line dedup, quality rules and extraction beside plain Python on awkward rows."""

import hashlib
import random
import re

import pytest

from broadsheet.llm import chat_format as chat
from broadsheet.llm import decontaminate, html_extract, line_dedup, quality_rules

LONG = "lorem ipsum dolor " * 60_000
DOCS = "doc_id bigint, text string, source string"


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# chat formatting


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|>", "<\\|x<|", "a\\nb\n", "<<|", "\\", "<|im_start|>user\nno<|im_end|>\n"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_line(chat.escape_line(text)) == text and "\n" not in chat.escape_line(text)


def test_templates_fold_and_stay_in_their_sandbox():
    tree = chat.fold(chat.parse("a{{ 'b' ~ ('c' | upper) }}{% if 'x' == 'y' %}no{% else %}d{% endif %}{# gone #}"))
    assert tree == (chat.Text("abCd"),)
    for bad in ("{{ m.role }}", "{{ messages }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{{ 'a' | eval }}", "{% if true %}", "{% do x %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    template = chat.compile_template("{% for m in messages %}{% if loop.first %}[{% elif not m.text == '' %},{% endif %}{% generation %}{{ m.text }}{% endgeneration %}{% endfor %}]")
    text, spans = next(chat.render(template, [{"role": "u", "text": t} for t in ("a", "", "bc")]))
    assert text == "[a,bc]" and [text[a:b] for a, b in spans] == ["a", "", "bc"]


def test_conversations_round_trip(spark):
    rows = [
        (1, 1, "assistant", "hi <|im_end|>"), (1, 0, "user", None), (1, 1, "assistant", "hi <|im_end|>"), (2, 0, None, ""), (2, None, "sys\ntem", "é<\\|"),
        (None, 5, "assistant", "no id"), (3, 0, "assistant", LONG),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS piece", "'x' AS spans")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(turns, piece_chars=10)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        row = got[conv]
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


# decontamination


def brute_contamination(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(13, len(w))
        for at in range(len(w) - n + 1) if w else ():
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[at : at + n]:
                    hit |= set(range(p, p + n))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_contamination_as_by_brute_force(spark, block_words):
    rng = random.Random(3)
    word = lambda: rng.choice("abcde") * rng.randint(1, 2)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((20, 13, 14, 12, 2, 1, 30))] + [(7, None), (8, "..."), (9, "É Été")]
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 12, 13, 60, 200)]
    texts += [texts[4] + "; " + items[0][1].upper() + " " + texts[3], items[1][1] + " " + items[1][1], None, "été É été x", LONG + items[6][1]]
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[5], "s"), (None, "a", None)]).selectExpr("*", "1 AS found", "2 AS n_words", "3 AS more")
    out, name = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_words=block_words)
    rows = out.collect()
    assert len(rows) == len(texts) + 2 and out.columns[:6] == docs.columns
    for r in rows:
        n, hit, found = brute_contamination(r.text, items)
        assert (r[name].n_words, r[name].n_hit, sorted(r[name]["items"])) == (n, hit, found), r.doc_id
        assert r[name].contaminated == (hit > 0 and 20 * hit >= n)


def test_contamination_of_empty_tables(spark):
    docs, bench = docs_of(spark, [(1, "a b", "s")]), spark.createDataFrame([], "item_id bigint, text string")
    out, name = decontaminate.contamination(docs, bench)
    assert out.first()[name].n_hit == 0 and not out.first()[name].contaminated
    out, _ = decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id bigint, text string"))
    assert out.count() == 0


# line dedup


def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(strip))
    held = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i)
    last = {k: max(x, key=lambda i: (i is not None, i or 0)) for k, x in held.items() if len(x) >= 3}
    return sorted(
        (str(i), len((t or "").split("\n")), "\n".join(x for x in (t or "").split("\n") if key(x) not in last or last[key(x)] == i)) for i, t, _ in rows
    )


@pytest.mark.parametrize(("batches", "fan_out"), [(1, 2), (4, 2), (5, 3)])
def test_lines_as_by_brute_force(spark, batches, fan_out):
    rng = random.Random(5)
    pool = [f"{'Shared Line of ÉTÉ' if i % 2 else 'line number with words'} {i}" for i in range(12)] + ["short", "", "   "]
    rows = [(i, "\n".join(rng.choice([x, x.upper(), f"\t{x} "]) for x in rng.choices(pool, k=rng.randint(0, 8))), "s") for i in range(25)]
    rows += [(3, rows[3][1], "s"), (None, pool[0] + "\n" + pool[1], None), (None, pool[0], None), (90, None, "s"), (91, "x\n" * 50_000 + pool[2], "s")]
    docs = docs_of(spark, rows).selectExpr("*", "1 AS drop", "2 AS n_lines")
    out = line_dedup.dedup_lines(docs, batches, fan_out)
    assert out.columns == [*docs.columns, "n_lines_", "n_dropped"]
    assert sorted((str(r.doc_id), r.n_lines_, r.text) for r in out.collect()) == brute_lines(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# quality rules


def test_base_figures_by_hand():
    assert quality_rules.base_figures(b"") == (0, 0, 0, 0, 0)
    assert quality_rules.base_figures("é# a b c\na b c\n\na b c".encode()) == (10, 11, 1, 1, 9)
    assert quality_rules.base_figures(b"a a a a") == (4, 4, 0, 0, 4)


def test_frequent_lines_of_one_host_reject_a_document(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    common = "Menu  of " + " ".join(f"m{j}" for j in range(200))
    rows = [(i, own(i) + "\n" + common, "hot") for i in range(40)] + [(i, own(i), "hot") for i in range(40, 50)]
    rows += [(50, own(50) + "\n" + common, None), (51, None, "hot"), (52, "", None), (40, own(40), "hot")]
    out = quality_rules.judge(docs_of(spark, rows).selectExpr("*", "1 AS row", "2 AS host", "3 AS lines")).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert not any(kept[i] for i in range(40)) and all(kept[i] for i in range(40, 51)) and not kept[51] and not kept[52]
    assert quality_rules.judge(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("table_lines", [100, 0])
def test_lines_above_the_limit_leave_the_text(spark, table_lines):
    own = lambda i: f"line {i} of its own\n\n second of {i}"
    rows = [(i, f"{own(i)}\n  Common\tLINE \nend {i}", "hot") for i in range(30)] + [(i, own(i), "hot") for i in range(30, 35)]
    rows += [(40, own(40) + "\ncommon line", None), (41, "common line", "cold"), (42, None, "hot"), (43, "COMMON line", "hot"), (0, "common line\nother", "hot"), (0, "common line\nelse", "cold")]
    rows += [(None, f"null {i}\ncommon line", "hot") for i in range(3)]
    docs = docs_of(spark, rows).selectExpr("*", "1 AS row", "2 AS found", "3 AS h1")
    out, name = quality_rules.clean(docs, table_lines=table_lines)
    got = out.collect()
    assert out.columns == [*docs.columns, name] and all((r.row, r.found, r.h1) == (1, 2, 3) for r in got)

    def left(text, source):
        return text if text is None or source != "hot" else "\n".join(x for x in text.split("\n") if x.lower().split() != ["common", "line"])

    assert sorted(map(str, ((r.doc_id, r.text, r.source) for r in got))) == sorted(str((i, left(t, s), s)) for i, t, s in rows)
    assert all(r[name].n_words - r[name].n_line_words == len((r.text or "").split()) for r in got)
    assert sum(r[name].n_line_words for r in got) == 2 * 35


def test_the_line_limit_is_a_count_and_a_share_of_the_host(spark):
    held = {("small", 100): {"nineteen": 19, "twenty": 20}, ("wide", 2100): {"one in a hundred": 21, "more of them": 22, "three": 3}}
    rows = []
    for (host, size), lines in held.items():
        rows += [(len(rows) + i, "\n".join([f"{host} {i}", *[x for x, n in lines.items() if i < n]]), host) for i in range(size)]
    out, name = quality_rules.clean(docs_of(spark, rows))
    got = out.select("doc_id", "text", f"{name}.n_line_words").collect()
    left = {x for r in got for x in r.text.split("\n")[1:]}
    assert left == {"nineteen", "one in a hundred", "three"}
    assert sum(r.n_line_words for r in got) == 20 + 3 * 22
    assert sorted((r.doc_id, r.text) for r in got) == sorted((i, "\n".join(x for x in t.split("\n") if x not in {"twenty", "more of them"})) for i, t, _ in rows)


# extraction


PAGE = """<html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><a href=x>Home</a></nav>
<div class="cookie-notice"><p>We use cookies, many of them indeed.</p></div><article><h1>The &Eacute;t&eacute;</h1><p>One&nbsp;two
 three &amp; <b>fo</b>ur.<p>Next<br>line here.</article><div id="comments"><p>I like it very much, thanks.</p></div><footer>&copy; us</footer>"""


def test_main_text_by_the_prior_and_by_labelled_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (1, "u", PAGE), (4, "u", "<p" * 50_000), (5, "u", "<p>" * 3000)], "page_id bigint, url string, html string")
    expected = "The Été One two three & four. Next line here."
    for truths in ([], [(1, "The Été\nOne two three & four.\nNext line here.")]):
        fitted = html_extract.train(pages, spark.createDataFrame(truths, "page_id bigint, truth string"))
        rows = html_extract.extract_text(pages, fitted).collect()
        assert sorted((r.page_id, r.text) for r in rows if r.page_id < 4) == [(1, expected), (1, expected), (2, ""), (3, "")]
    assert html_extract.extract_text(pages.limit(0), fitted).count() == 0


def site_page(i):
    core = [f"This is sentence {i} number {j} of the article with several plain words." for j in range(4)]
    rail = [f"Rail item {i} number {j} with several other plain words in a row." for j in range(4)]
    body = "".join(f"<div class='{name}'>" + "".join(f"<p>{x}</p>" for x in lines) + "</div>" for name, lines in (("zq-rail", rail), ("zq-core", core)))
    return f"<html><body>{body}</body></html>", "\n".join(core)


def test_names_of_a_site_are_learned_from_its_labelled_pages(spark):
    pages = spark.createDataFrame([(i, f"u{i}", site_page(i)[0]) for i in range(120)], "page_id bigint, url string, html string")
    truths = spark.createDataFrame([(i, site_page(i)[1]) for i in range(60)], "page_id bigint, truth string")
    right = {i: " ".join(site_page(i)[1].split("\n")) for i in range(120)}
    learned = html_extract.extract_text(pages, html_extract.train(pages, truths)).collect()
    assert all(r.text == right[r.page_id] for r in learned)
    unlearned = html_extract.extract_text(pages, html_extract.train(pages, truths.limit(0))).collect()
    assert not any(r.text == right[r.page_id] for r in unlearned)


def test_messages_give_the_marginals_of_the_whole_tree():
    nodes = html_extract.tree_of("<body><div><p>Some words here.</p><ul><li>x</li></ul></div><p>More words.</p></body>")
    model = html_extract.Potentials.of(html_extract.prior_counts())
    import itertools

    import numpy as np

    local = []
    for n in nodes:
        z = sum(model.odds.get(f, 0.0) for f in html_extract.features(n))
        local.append(1 / (1 + np.exp(-z)))
    total, content = 0.0, np.zeros(len(nodes))
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        p = 1.0
        for i, y in enumerate(labels):
            p *= (local[i] if y else 1 - local[i]) * (model.edge[labels[nodes[i].parent], y] if i else 1)
        total += p
        content += p * np.array(labels)
    assert np.allclose(model.marginals(nodes), content / total)
