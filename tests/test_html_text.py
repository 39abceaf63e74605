"""Literal expectations of the text layer, independent of any oracle."""

import math

import pytest
import regex as re
from pyspark.sql import functions as F

from inkwell.functions import html as H
from inkwell.functions import values as V
from inkwell.functions.language import BUCKETS, detect_language, learn_profiles, ending_buckets
from inkwell.operators.audit import audit_keyword_density, audit_metadata
from inkwell.operators.headings import normalise_levels


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column).first()[0]


@pytest.mark.parametrize("html,kept", [
    ("<header>a<header>b</header>c</header><p>keep</p>", "<p>keep</p>"),
    ("1<nav>2<nav>3<nav>4</nav>5</nav></nav>6", "16"),
    ("<NAV class=\"a > b\">x</NAV>y<aside>z</aside>", "y"),
    ("a</nav>b<footer>c</footer>d", "abd"),
    ("x<nav>never closed", "x"),
    ("<navigation>stays</navigation>", "<navigation>stays</navigation>"),
    ("", ""), (None, None),
])
def test_boilerplate(spark, html, kept):
    assert one(spark, html, H.strip_boilerplate("x")) == kept


@pytest.mark.parametrize("html,text", [
    ("caf&eacute; &#8217; &mdash; &#x2014; &amp;lt; &bogus; &#0; A&B", "café ’ — — &lt; &bogus; &#0; A&B"),
    ("<p title=\"a > b\">one</p><p title='it\"s'>two</p>", "one two"),
    ("before<script>var a = '</p>';", "before"),
    ("<!-- <p>no</p> -->yes<!-- open", "yes"),
    ("one two&nbsp; three", "one two three"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
])
def test_visible_text(spark, html, text):
    assert one(spark, html, H.html_to_text("x")) == text


def test_words_and_trimming(spark):
    assert one(spark, "a b   c", H.word_count("x")) == 3
    assert one(spark, " APPROVE ", V.strip_ws("x")) == "APPROVE"
    assert [one(spark, t, V.parse_float("x")) for t in ("12d", "12", " 1e2 ", "x", None)] == [0.0, 12.0, 100.0, 0.0, 0.0]


def test_language_reads_the_whole_text(spark):
    rows = [("the cat and the dog of this house", "en"), ("der hund und die katze nicht", "de"), ("zzz", None), (None, "en")]
    p = learn_profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert p.languages == ("de", "en")
    late = "xx " * 2000 + "the house of this cat and the dog " * 40
    assert [one(spark, t, detect_language(F.col("x"), p)) for t in (late, "die Katze", "", "12 ?!", None)] == ["en", "de", "fr", "fr", "fr"]
    assert one(spark, "any", detect_language(F.col("x"), learn_profiles(spark.createDataFrame([], "text string, lang string")))) == "fr"


def test_language_learns_from_every_text(spark):
    rows = [(f"the {i}", "en") for i in range(9000)] + [(f"die {i}", "de") for i in range(2)]
    p = learn_profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert p.languages == ("de", "en")
    for weights, word, n in zip(p.weights, ("die", "the"), (2, 9000)):
        b = (ord(word[0]) * 961 + ord(word[1]) * 31 + ord(word[2])) % BUCKETS
        assert weights[b] == round(1000 * math.log((n + 0.5) / (n + 0.5 * BUCKETS)))


def test_language_of_texts_not_learned_from(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    p = learn_profiles(d.where("doc_id % 3 > 0"))
    held = d.where("doc_id % 3 = 0").select("lang", detect_language(F.col("text"), p).alias("got")).collect()
    assert len(held) > 300 and sum(r.lang == r.got for r in held) >= 0.98 * len(held)


def test_word_endings_by_plain_code(spark):
    for t in ("", "a", "Ab cédé!", "  x--yzw ", "日本語語 ok", "e\u0301abc", "1"):
        ends = [[ord(c) for c in w[-3:]] + [0, 0] for w in re.findall(r"\p{L}+", t.lower())]
        want = [(e[0] * 961 + e[1] * 31 + e[2]) % BUCKETS for e in ends]
        assert one(spark, t, ending_buckets(F.col("x"))) == want


def test_level_repair(spark):
    def fold(raw):
        out, last = [], 1
        for x in raw:
            last = min(x, last + 1)
            out.append(last)
        return out

    for raw in ([], [1], [6, 6, 6, 6, 6, 6, 6], [1, 3, 6, 2, 4, 6, 6, 1, 5], [4, 4, 2, 6, 3, 6, 6, 6, 6, 6]):
        got = spark.createDataFrame([(raw,)], "x array<int>").select(normalise_levels(F.col("x"))).first()[0]
        assert got == fold(raw)


def test_whole_phrase_density(spark):
    d = spark.createDataFrame([(1, "<p>party started cart (art) Art. art2</p>", "art"), (2, "<p>a.b a.b axb</p>", "a.b")],
                              "article_id int, body_html string, target_keyword string")
    assert {r.article_id: r.occurrences for r in audit_keyword_density(d).collect()} == {1: 2, 2: 2}


def test_slug_of_a_phrase(spark):
    d = spark.createDataFrame([(1, True, "running-shoes-guide-pro", "running shoes"), (2, True, "runner-guide-pro-tips", "running shoes")],
                              "article_id int, valid boolean, slug string, keyword string")
    for c in ("title_tag", "meta_description", "og_description"):
        d = d.withColumn(c, F.lit("x"))
    assert {r.article_id: r.slug_ok for r in audit_metadata(d).collect()} == {1: True, 2: False}
