"""Cases (inputs and expected values) taken from the reference's own tests,
run through our DataFrame operators."""

import datetime as dt

from pyspark.sql import functions as F

from inkwell.operators import events as E
from inkwell.operators import headings as HD
from inkwell.operators import keywords as K
from inkwell.operators import reports as R
from inkwell.operators import scores as S


def test_route_comment_cases(spark):
    rows = [("1", "APPROVE"), ("2", "approve"), ("3", "REJECT: The tone is off-brand"), ("4", "REJECT"),
            ("5", "Looks good to me"), ("6", "APPROVED thanks"), ("7", "REJECTED: x")]
    df = spark.createDataFrame(rows, "task_gid string, comment_text string")
    out = {r.task_gid: (r.decision, r.reason) for r in E.route_comment(df).collect()}
    assert out["1"] == ("approve", None) and out["2"] == ("approve", None)
    assert out["3"] == ("reject", "The tone is off-brand")
    assert out["4"] == ("reject", "No reason provided.")
    assert "5" not in out
    assert out["6"][0] == "approve"
    assert out["7"] == ("reject", "ED: x")


def test_next_business_day(spark):
    df = spark.createDataFrame([(dt.date(2026, 4, 2),), (dt.date(2026, 4, 3),), (dt.date(2026, 4, 4),)], "d date")
    got = [r.n for r in df.select(R.next_business_day("d").alias("n")).collect()]
    assert got == [dt.date(2026, 4, 3), dt.date(2026, 4, 6), dt.date(2026, 4, 6)]


def test_secondary_keyword_ranking(spark):
    # ratios 200, 80, 500, 150, 400, 100 -> c, e, a, d, f
    rows = [("s", 1, "a", 2000, 10.0), ("s", 2, "b", 800, 10.0), ("s", 3, "c", 5000, 10.0),
            ("s", 4, "d", 1500, 10.0), ("s", 5, "e", 4000, 10.0), ("s", 6, "f", 1000, 10.0)]
    df = spark.createDataFrame(rows, "seed string, pos int, keyword string, volume bigint, difficulty double")
    got = [r.keyword for r in K.secondary_keywords(df).orderBy("rank").collect()]
    assert got == ["c", "e", "a", "d", "f"]


def test_zero_difficulty_counts_as_one(spark):
    df = spark.createDataFrame([(500, 0.0)], "volume bigint, difficulty double")
    assert df.select(K.keyword_ratio().alias("r")).first().r == 500.0


def test_report_parsing(spark):
    ok = "Keyword;Search Volume;Keyword Difficulty;CPC\nrunning shoes;12000;45.5;1.20"
    rows = [(1, "running shoes", ok), (2, "seed", "Keyword;Search Volume"), (3, "seed", "Keyword;A;B;C\nonly;two")]
    df = spark.createDataFrame(rows, "report_id int, seed string, report string")
    out = {r.report_id: r for r in K.keyword_overview_parse(df).collect()}
    assert (out[1].keyword, out[1].volume, out[1].difficulty, out[1].cpc) == ("running shoes", 12000, 45.5, 1.2)
    assert (out[2].keyword, out[2].volume, out[2].difficulty) == ("seed", 0, 0.0)
    assert out[3].volume == 0


def test_parse_value_quirks(spark):
    from inkwell.functions.values import parse_float, parse_int
    df = spark.createDataFrame([(" 12 ",), ("12.0",), ("N/A",), (None,)], "v string")
    got = [(r.i, r.f) for r in df.select(parse_int("v").alias("i"), parse_float("v").alias("f")).collect()]
    assert got == [(12, 12.0), (0, 12.0), (0, 0.0), (0, 0.0)]


def _rewrite(spark, body, title="My Title"):
    df = spark.createDataFrame([("a", title, body)], "article_id string, title string, body_html string")
    return HD.normalize_html_structure(df).first()


def test_heading_cases(spark):
    r = _rewrite(spark, "<h1>A</h1><h1>B</h1><h1>C</h1>")
    assert list(r.levels) == [1, 2, 2]
    r = _rewrite(spark, "<h1>A</h1><h2>B</h2><h4>C</h4>")
    assert list(r.levels) == [1, 2, 3]
    r = _rewrite(spark, "<h1>A</h1><h3>B</h3>")
    assert list(r.levels) == [1, 2]
    r = _rewrite(spark, "<p>x</p><h2>B</h2>")
    assert r.h1_inserted and r.normalized_html.startswith("<!-- INTRODUCTION START --><h1>My Title</h1><p>x</p>")
    assert _rewrite(spark, "   ").normalized_html == "   "


def test_conclusion_markers(spark):
    body = "<h1>T</h1><p>i</p><h2>Body</h2><p>b</p><h2>En résumé</h2><p>c</p>"
    html = _rewrite(spark, body).normalized_html
    assert "<!-- CONCLUSION START --><h2>En résumé</h2><p>c</p><!-- CONCLUSION END -->" in html
    body = "<h1>T</h1><h2>Conclusion</h2><p>c</p><h3>Sub</h3><p>d</p>"
    html = _rewrite(spark, body).normalized_html
    assert "<p>c</p><!-- CONCLUSION END --><h3>Sub</h3>" in html


def test_similarity_threshold(spark):
    arts = spark.createDataFrame([("a",), ("b",), ("c",)], "article_id string")
    m = spark.createDataFrame([("a", "20", None, None), ("a", "8", None, None), ("b", None, "15", None)],
                              "article_id string, percentmatched string, minper string, percent string")
    out = {r.article_id: (r.max_similarity, r.plagiarism_flagged) for r in S.max_similarity_flag(arts, m).collect()}
    assert out == {"a": (20.0, True), "b": (15.0, False), "c": (0.0, False)}


def test_score_delta(spark):
    df = spark.createDataFrame([(50.0, 75.0), (0.0, 40.0)], "initial double, final double")
    got = [(r.score_delta, r.score_delta_pct) for r in S.score_delta(df).collect()]
    assert got == [(25.0, 50.0), (40.0, 0.0)]


def test_poll_first_done(spark):
    rows = [("d1", 1, "pending", 0.0), ("d1", 2, "pending", 0.0), ("d1", 3, "done", 72.0),
            ("d2", 1, "pending", 0.0)]
    df = spark.createDataFrame(rows, "doc_id string, attempt int, status string, content_score double")
    out = {r.doc_id: (r.outcome, r.attempt, r.content_score) for r in S.poll_first_done(df, 3).collect()}
    assert out == {"d1": ("done", 3, 72.0), "d2": ("timeout", None, None)}


def test_internal_links_format(spark):
    df = spark.createDataFrame([([],), ([{"location": "intro", "suggested_topic": "shoes"}],)],
                               "l array<struct<location:string,suggested_topic:string>>")
    got = [r.t for r in df.select(R.format_internal_links("l").alias("t")).collect()]
    assert got == ["  None suggested.", "  • Near 'intro': link to 'shoes'"]


def test_signature_filter(spark):
    import base64
    import hashlib
    import hmac
    payload = '{"id": 1, "status": "draft"}'
    good = base64.b64encode(hmac.new(b"k", payload.encode(), hashlib.sha256).digest()).decode()
    df = spark.createDataFrame([(1, payload, good), (2, payload, "bad")], "delivery_id int, payload string, signature string")
    assert [r.delivery_id for r in E.signature_filter_base64(df, "k").collect()] == [1]
    assert E.signature_filter_base64(df, "").count() == 0


def test_state_machine_fold(spark):
    from inkwell.operators.runs import run_state_machine
    t = dt.datetime(2024, 1, 1)
    ev = [("a", t, 1, "created"), ("a", t, 2, "started"), ("a", t, 3, "scored"), ("a", t, 4, "approve"),
          ("b", t, 5, "started"), ("c", t, 6, "created"), ("c", t, 7, "reject")]
    df = spark.createDataFrame(ev, "article_id string, ts timestamp_ntz, event_id bigint, action string")
    out = {r.article_id: r.status for r in run_state_machine(df).collect()}
    assert out == {"a": "completed", "c": "rejected"}
