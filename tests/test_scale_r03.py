"""Plans and staged feeds that have to stay bounded as their input grows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkwell.operators import audit as AU
from inkwell.operators import competitors as C
from inkwell.operators import headings as HD
from inkwell.streaming import jobs as S


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("column", ["conclusion_at", "intro_start"])
def test_a_filter_on_the_heading_plan_does_not_repeat_its_expressions(spark, column):
    d = spark.createDataFrame([("1", "<h1>T</h1><h2>Conclusion</h2><p>a</p>", "T")],
                              "article_id string, body_html string, title string").where("body_html is not null")
    plan = HD.with_heading_plan(d).where(F.col(column) > 0).select("article_id", column)
    assert plan_of(plan).count("regexp_extract_all(hidden_body") == 2  # levels and texts
    assert [tuple(r) for r in plan.collect()] == [("1", 2 if column == "conclusion_at" else 1)]


def test_slices_of_a_feed_are_many_small_files(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i), f"{i * 7919 % 10007}" * 20) for i in range(3000)] + [(None, None, "dropped")]
    feed = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, payload string")
    slice_no = F.floor(F.col("event_id") / 1000).cast("int")
    path = S.stage_slices(feed, slice_no, "test", 4, file_bytes=4096)  # the last slice is empty
    files = S.files_a_slice(spark, path, 4)
    assert files > 1 and len(S._files(spark, path)) == 4 * files
    stream = S.read_feed(spark, path, feed.schema, files)
    out = S.read_sink(spark, S.run_stream(stream, "test", lambda b: b), "event_id bigint, _batch bigint").collect()
    assert sorted((r.event_id, r._batch) for r in out) == [(i, i // 1000) for i in range(3000)]


def test_question_matches_of_repeated_and_null_ids(spark):
    h = spark.createDataFrame(
        [("1", "k", 0, "What is K?"), ("1", "k", 0, "What is K?"), (None, "k", 1, "is what k else"), ("2", None, 0, "What is K?")],
        "article_id string, keyword string, seq int, text string")
    q = spark.createDataFrame([("k", "what is k"), ("k", "?"), (None, "what is k"), ("k", "gone")], "keyword string, question string")
    got = AU.question_matches(h, q)
    assert sorted((str(r.article_id), r.seq, r.question, r.equal) for r in got.collect()) == [
        ("1", 0, "what is k", True), ("1", 0, "what is k", True), ("None", 1, "what is k", False)]
    # the words of all headings meet the questions without the headings' texts
    assert "xxhash64(keyword" in plan_of(got)


def test_links_of_competitors_are_ranked_once(spark):
    """What fetches the links reads them staged, in every branch."""
    results = spark.createDataFrame([("k", i, 0, f"https://a/{i}") for i in range(5)] + [("k", 5, 0, "https://reddit.com/x")],
                                    "keyword string, position bigint, entry int, link string")
    web = spark.createDataFrame([(i, f"https://a/{i}", f"<h1>T</h1><h2>H{i}</h2>") for i in range(5)],
                                "web_id bigint, url string, html string")
    top = C.competitor_links(results)
    fetched = C.fetch_competitors(top, web)
    assert "row_number" not in plan_of(fetched)
    s = C.competitor_structure(results.select("keyword"), top, fetched)
    assert [(r.competitor_urls, r.h2_topics, r.avg_h2_count) for r in s.collect()] == [
        ([f"https://a/{i}" for i in range(3)], ["H0", "H1", "H2"], 1)]
