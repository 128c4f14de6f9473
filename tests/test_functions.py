from pyspark.sql import functions as F

from broadsheet.functions import markup
from broadsheet.functions import tokens as tok
from broadsheet.functions import vectors as vec


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text STRING").select(column).first()[0]


def test_tokens_lower_split_and_drop_empty_parts(spark):
    assert one(spark, "...Hello, World_2! ", tok.tokens("text")) == ["hello", "world_2"]
    assert one(spark, "?!", tok.tokens("text")) == []
    assert one(spark, "", tok.tokens("text")) == []


def test_accented_letters_separate_words(spark):
    assert one(spark, "Été naïf", tok.tokens("text")) == ["t", "na", "f"]


def test_kept_words(spark):
    kept = tok.keep_words(tok.tokens("text"), ["the"], 3)
    assert one(spark, "The cat is 42 a_b c3po the dog", kept) == ["cat", "dog"]
    assert one(spark, "The cat", tok.keep_words(tok.tokens("text"))) == ["the", "cat"]


def test_has_letters(spark):
    words = spark.createDataFrame([("é1",), ("12",), ("_",), ("a",)], "w STRING")
    assert [r.w for r in words.where(tok.has_letters(F.col("w"))).collect()] == ["é1", "a"]


def test_blank_corpus_and_rejoin(spark):
    assert one(spark, "a  b ", tok.rejoin(tok.blank_tokens("text"))) == "a b"


def test_markup_keeps_visible_text_only(spark):
    cases = {
        "Paris is [[capital city|the capital]] of [[France]].": " paris is the capital of france ",
        "[[Image:map.png|thumb|250px|A map of Rome]]": " a map of rome ",
        "[http://x.org/page the page] {{stub}} {table}": " the page ",
        "See &lt;ref name=a&gt;book&lt;/ref&gt; &amp;nbsp; 42": " see four two ",
        "[[Category:Cities|*]] [[de:Stadt]]": " cities ",
        "one<br>two\nthree": " one two\nthree ",
        "<p>alpha</p><p>beta</p>": " alpha beta",
        "AT&T rules<p>more text; end</p>": " at t rules more text end",
        "ÉCOLE": " cole ",
    }
    for text, clean in cases.items():
        got = one(spark, text, markup.clean_markup("text"))
        assert got.rstrip() == clean.rstrip(), text
        assert not got.endswith("  ")


def test_text_elements_gate_the_dump(spark):
    dump = '<page><title>t</title><text xml:space="preserve">kept</text></page><text x="1">#redirect [[a]]</text>'
    assert one(spark, dump, markup.text_elements("text")) == ["kept"]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, -2.0], [0.0, 2.0])], "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>")
    row = df.select(
        vec.concat_vectors("a", "b").alias("both"),
        vec.l1_norm("a").alias("norm"),
        vec.squared_distance("a", "b").alias("distance"),
        vec.squared_distances("a", [[1.0, -2.0], [0.0, 0.0]]).alias("distances"),
        vec.project("a", [[1.0, 0.0, 2.0], [0.0, 1.0, 1.0]]).alias("projected"),
        vec.vector_text("a").alias("text"),
    ).first()
    assert row.both == [1.0, -2.0, 0.0, 2.0]
    assert row.norm == 3.0
    assert row.distance == 17.0
    assert row.distances == [0.0, 5.0]
    assert row.projected == [1.0, -2.0, 0.0]
    assert row.text == "1.0,-2.0"


def test_nearest_takes_the_first_of_equal_distances(spark):
    df = spark.createDataFrame([([2.0, 1.0, 1.0],)], "d ARRAY<DOUBLE>")
    assert df.select(vec.nearest("d")).first()[0] == 1
