"""Headings in containers, comments and raw text: literal results."""

import pytest

from inkwell.functions import html as H
from inkwell.operators import headings as HD

I0, I1, C0, C1 = HD.INTRO_START, HD.INTRO_END, HD.CONCLUSION_START, HD.CONCLUSION_END


def rewritten(spark, body):
    d = spark.createDataFrame([(1, body, "Title")], "article_id int, body_html string, title string")
    return HD.normalize_html_structure(d).first().normalized_html


@pytest.mark.parametrize("body,want", [
    # the conclusion ends inside its container, not at a heading outside it
    ("<h1>T</h1><div><h2>Conclusion</h2><p>a</p></div><h3>x</h3>",
     f"{I0}<h1>T</h1><div>{I1}{C0}<h2>Conclusion</h2><p>a</p>{C1}</div><h3>x</h3>"),
    # a heading in a sibling element does not end it, the next one beside it does
    ("<h1>A</h1><h2>Summary</h2><div><h3>in</h3></div><h3>beside</h3>",
     f"{I0}<h1>A</h1>{I1}{C0}<h2>Summary</h2><div><h3>in</h3></div>{C1}<h3>beside</h3>"),
    # text after the last element stays outside; so it does after a script
    ("<h1>T</h1><h2>Conclusion</h2><p>a</p>tail", f"{I0}<h1>T</h1>{I1}{C0}<h2>Conclusion</h2><p>a</p>{C1}tail"),
    ("<h1>T</h1><h2>Conclusion</h2>b<br>c<script>'<h2>no</h2>'</script>tail",
     f"{I0}<h1>T</h1>{I1}{C0}<h2>Conclusion</h2>b<br>c<script>'<h2>no</h2>'</script>{C1}tail"),
    # elements without closing tags
    ("<h1>T</h1><section><h2>Conclusion</h2><p>a<p>b</section>c",
     f"{I0}<h1>T</h1><section>{I1}{C0}<h2>Conclusion</h2><p>a<p>b{C1}</section>c"),
    ("<h1>T</h1><p>open<h2>Conclusion</h2><ul><li>a<li>b",
     f"{I0}<h1>T</h1><p>open{I1}{C0}<h2>Conclusion</h2><ul><li>a<li>b{C1}"),
    # neither comments nor raw text hold headings
    ("<!-- <h1>no</h1> --><p>x</p><textarea><h2>Conclusion</h2></textarea>",
     "<!-- <h1>no</h1> --><h1>Title</h1><p>x</p><textarea><h2>Conclusion</h2></textarea>"),
    ("a<!-- c --><style>h1>h2{}</style><h4 title='1 > 0'>x<!-- y --></h4>",
     f"a<!-- c -->{I0}<h1>Title</h1><style>h1>h2{{}}</style>{I1}<h2 title='1 > 0'>x<!-- y --></h2>"),
    # the marks that stand for hidden parts may be in the text themselves
    ("\ue000<h1>\ue001</h1><!-- c -->\ue000", "\ue000<h1>\ue001</h1><!-- c -->\ue000"),
    ("<h2>Conclusion</h2>", f"{I0}<h1>Title</h1>{I1}{C0}<h2>Conclusion</h2>{C1}"),
    (" \n", " \n"), ("", ""),
])
def test_rewrite(spark, body, want):
    assert rewritten(spark, body) == want


@pytest.mark.parametrize("html,paths", [
    ("<h1>a</h1><div><p>x<h2>b</h2></div></div><h3>c</h3>", ["", "div", ""]),
    ("<main><ul><li><h2>a</h2><li><h2>b</h2></ul><b><h3>c</h3></b><img><h4>d</h4></main>",
     ["main/ul/li", "main/ul/li", "main/b", "main"]),
    ("<div><span><h2>a</h2></div><h2>b</h2>", ["div/span", ""]),
    ("<!-- <div> --><h2>a</h2><script>'<div>'</script><h2>b</h2>", ["", ""]),
    ("<DIV class='>'><H2>a</H2></DIV>", ["div"]), ("no heading", []),
])
def test_containers(spark, html, paths):
    got = spark.createDataFrame([(html,)], "x string").select(
        H.heading_containers(H.hide_raw("x")).alias("c")).first().c
    assert [c.path for c in got] == paths


def test_a_long_page(spark):
    page = "<div>" * 50 + "<p>text</p><h2>x</h2>" * 3000 + "</div>" * 50
    got = spark.createDataFrame([(page,)], "x string").select(H.heading_containers(H.hide_raw("x")).alias("c")).first().c
    assert len(got) == 3000 and got[-1].path.count("div") == 50
