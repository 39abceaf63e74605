"""Operators on small inputs with literal results: branches that the staged
tables do not reach, and streams in several batches."""

from pyspark.sql import functions as F

from inkwell.operators import audit as AU
from inkwell.operators import competitors as C
from inkwell.operators import runs as RU
from inkwell.sources import views as V
from inkwell.streaming import jobs as S
from inkwell.streaming import state as ST


def test_competitor_structure_falls_back_to_the_template(spark):
    top = spark.createDataFrame([("a", 1, "http://x/1"), ("a", 2, "http://x/2"), ("b", 1, "http://y/1")],
                                "keyword string, rank int, link string")
    web = spark.createDataFrame(
        [("http://x/1", 7, "<h2>No</h2>"), ("http://x/1", 3, "<nav><h2>Nav</h2></nav><h2>One</h2><h2>Two</h2> a b"),
         ("http://x/2", 5, "<h2>one</h2><h2>Three</h2> c")], "url string, web_id int, html string")
    kws = spark.createDataFrame([("a",), ("b",), ("c",)], "keyword string")
    out = {r.keyword: r for r in C.competitor_structure(kws, top, C.fetch_competitors(top, web)).collect()}
    assert out["a"].structure_source == "competitors" and out["a"].h2_topics == ["One", "Two", "Three"]
    assert out["a"].competitor_urls == ["http://x/1", "http://x/2"] and out["a"].avg_h2_count == 2
    assert out["b"].structure_source == out["c"].structure_source == "template"
    assert out["b"].competitor_urls == ["http://y/1"] and out["c"].competitor_urls == []
    assert out["c"].avg_word_count == C.FALLBACK_WORD_COUNT and out["c"].h2_topics[0] == "What is c"


def test_voice_counts_phrases(spark):
    d = spark.createDataFrame(
        [(1, "<p>It was. To be to be, very</p>", "en"), (2, "<p>for the with the</p>", "en"), (3, "<p>it was</p>", "de")],
        "article_id int, body_html string, language string")
    out = {r.article_id: (r.avoid_count, r.use_count) for r in AU.audit_voice_phrases(d).collect()}
    assert out == {1: (4, 0), 2: (0, 2), 3: (0, 0)}


def test_question_and_secondary_audits_have_both_outcomes(spark):
    a = spark.createDataFrame(
        [(1, "<h2>x</h2><h2>Why is it SO?</h2>", "k"), (2, "<h2>So why, of all things, is it?</h2>", "k"),
         (3, "<h2>Why so?</h2>", "k"), (4, "<h2>why is it so</h2>", "other"), (5, "<p>none</p>", "k"), (6, "<h2>why so</h2>", None)],
        "article_id int, body_html string, target_keyword string")
    q = spark.createDataFrame([("k", "why is it so"), ("k", "never asked here"), ("k", "?")], "keyword string, question string")
    assert {r.article_id: (r.question_h2s, r.matched_h2s, r.ok) for r in AU.audit_question_h2(a, q).collect()} == {
        1: (1, 1, True), 2: (1, 1, True), 3: (1, 0, False), 4: (0, 0, False), 5: (0, 0, False), 6: (0, 0, False)}
    h = spark.createDataFrame([(1, "k", 0, "Why is it SO?"), (2, "k", 0, "so why is it")], "article_id int, keyword string, seq int, text string")
    assert {(r.article_id, r.equal) for r in AU.question_matches(h, q).collect()} == {(1, True), (2, False)}
    h = spark.createDataFrame([(1, "s", 1, 2, "Red shoes"), (1, "s", 2, 3, "blue SHOES"), (2, "s", 1, 2, "hats")],
                              "article_id int, seed string, seq int, level int, heading_text string")
    kw = spark.createDataFrame([("s", "Shoes")], "seed string, keyword string")
    assert {r.article_id: r.ok for r in AU.audit_secondary_headings(h, kw).collect()} == {1: True, 2: False}


def test_phrases_in_pages_are_counted_by_position(spark):
    texts = [(1, "a b a b c a".split()), (2, "b a".split()), (3, [])]
    wanted = [(i, p, p.split()) for i in (1, 2, 3) for p in ("a", "a b", "b a b", "a b a b c a", "c a x", "a a")]
    got = AU.phrase_occurrences(spark.createDataFrame(texts, "text_id int, words array<string>"),
                                spark.createDataFrame(wanted, "text_id int, phrase string, words array<string>"))
    assert {(r.text_id, r.phrase): r.occurrences for r in got.collect()} == {
        (1, "a"): 3, (1, "a b"): 2, (1, "b a b"): 1, (1, "a b a b c a"): 1, (2, "a"): 1}
    pages = spark.createDataFrame([("k", 1, "Red shoes, red SHOES and more", 6), ("k", 2, "none here", 2), ("k", 3, "", 0)],
                                  "keyword string, web_id int, text string, word_count int")
    d = AU.competitor_density(pages, spark.createDataFrame([("k", "red shoes"), ("k", "hats"), ("x", "hats")], "keyword string, phrase string"))
    assert {(r.keyword, r.phrase): (r.pages, r.occurrences, round(r.density, 4)) for r in d.collect()} == {
        ("k", "red shoes"): (3, 2, 11.1111), ("k", "hats"): (3, 0, 0.0)}


def test_streams_in_many_batches_equal_the_batch_form(spark):
    sf = "/root/testdata/sf0.001"
    events = V.v_run_events(spark, sf)
    batch = {(r.article_id, r.status) for r in RU.run_state_machine(events).collect()}
    path = S.stage(events.repartition(5), "run-events")  # every file spans all the time
    for delay in ("60 days", "1 hour"):  # nothing late; nearly everything late
        got = ST.stream_state_machine(spark, path, events.schema, delay, max_files=1).collect()
        assert {(r.article_id, r.status) for r in got} == batch
    hooks = V.v_webhooks(spark, sf).repartition(5)
    whole = S.stream_draft_intake(spark, hooks, V.v_runs(spark, sf), V.DEFAULT_STORE_SECRET)
    parts = S.stream_draft_intake(spark, hooks, V.v_runs(spark, sf), V.DEFAULT_STORE_SECRET, max_files=1)
    assert sorted(whole.collect()) == sorted(parts.collect()) and whole.count() > 0


def test_empty_sink_and_broken_sink(spark, tmp_path):
    import pytest

    assert S.read_sink(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        S.read_sink(spark, str(tmp_path / "bad"), "a int").collect()


def test_state_machine_on_interleaved_files(spark):
    rows = [("a", f"2024-01-01 00:00:{i:02d}", i, x) for i, x in enumerate(["created", "started", "scored", "approve", "reject"])]
    ev = spark.createDataFrame(rows, "article_id string, ts string, event_id long, action string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    ev = ev.withColumn("reason", F.when(F.col("action") == "reject", "too short"))
    want = [("a", "rejected", "Rejected: too short")]
    assert [tuple(r) for r in RU.run_state_machine(ev).collect()] == want
    parts = [RU.fold_transitions(ev.where(c), ["article_id"]) for c in ("event_id >= 3", "event_id < 3")]
    assert [tuple(r) for r in RU.final_status(parts[0].union(parts[1])).collect()] == want


def test_poll_lists(spark):
    from inkwell.operators.scores import poll_first_done

    rows = [("d", 1, "pending", 1.0, ["x"], None), ("d", 2, "done", 5.0, ["a", "b"], None), ("d", 3, "done", 9.0, ["z"], ["h"])]
    polls = spark.createDataFrame(rows, "doc_id string, attempt int, status string, content_score double, "
                                        "lsi_keywords array<string>, suggested_headings array<string>")
    (r,) = poll_first_done(polls).collect()
    assert (r.attempt, r.lsi_keywords, r.suggested_headings) == (2, ["a", "b"], [])
