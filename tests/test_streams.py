"""Streams whose files come out of order, late or twice, and sinks that survive
a repeated batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkwell.functions.signatures import hmac_sha256_base64
from inkwell.session import scratch_path, store_of
from inkwell.sources import published as P
from inkwell.sources.views import RUN_COLUMNS
from inkwell.streaming import jobs as S
from inkwell.streaming import run_table as RT
from inkwell.streaming import state as ST

EVENTS = "article_id string, ts timestamp_ntz, event_id bigint, action string, reason string"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def feed(spark, schema, *files):
    """A feed of one file per list of rows, in this order."""
    path = scratch_path(spark, "feed")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def events(*rows):
    return [(a, at(m), i, action, reason) for a, m, i, action, reason in rows]


def test_status_when_files_overlap_and_come_backwards(spark):
    path = feed(
        spark, EVENTS,
        events(("a", 30, 4, "approve", None), ("b", 5, 9, "created", None), ("c", 1, 20, "started", None)),
        events(("a", 20, 3, "scored", None), ("a", 0, 1, "created", None), ("b", 6, 10, "reject", "no")),
        events(("a", 10, 2, "started", None), ("b", 6, 11, "created", None)),
        events(("d", 40, 30, "created", None), ("d", 40, 31, "failed", None)))
    schema = spark.read.parquet(path).schema
    want = {"a": ("completed", None), "b": ("rejected", "Rejected: no"), "d": ("failed", None)}
    for delay in ("1 hour", "0 seconds"):  # in time; late, settled from the feed
        got = ST.stream_state_machine(spark, path, schema, delay, max_files=1).collect()
        assert {r.article_id: (r.status, r.failure_reason) for r in got} == want


def test_timers_raise_what_no_later_event_of_the_key_does(spark):
    path = feed(
        spark, EVENTS,
        events(("in time", 0, 1, "created", None), ("too late", 0, 2, "created", None), ("never", 0, 3, "created", None)),
        events(("in time", 60, 4, "started", None), ("too late", 61, 5, "started", None), ("unknown", 9, 6, "started", None)),
        events(("out of order", 130, 8, "failed", None), ("out of order", 100, 7, "created", None)),
        events(("open", 390, 9, "created", None), ("x", 400, 10, "failed", None)))
    schema = spark.read.parquet(path).schema
    got = ST.stream_stale_runs(spark, path, schema, "60 minutes", "2 hours", max_files=1).collect()
    assert {r.article_id: (r.created_at, r.stale_at) for r in got} == {
        k: (at(0), at(60)) for k in ("too late", "never")}


def test_polls_time_out_by_attempt_and_by_time(spark):
    schema = ("doc_id string, ts timestamp_ntz, event_id bigint, attempt int, status string, content_score double, "
              "lsi_keywords array<string>, suggested_headings array<string>")
    rows = [("slow", at(0), 1, 1, "pending", 1.0, None, None), ("slow", at(11), 2, 2, "done", 2.0, None, None),
            ("good", at(0), 3, 1, "pending", None, None, None), ("good", at(10), 4, 2, "done", None, ["t"], None),
            ("good", at(9), 5, 1, "pending", 9.0, None, None), ("silent", at(1), 6, 1, "pending", 1.0, None, None),
            ("many", at(0), 7, 1, "pending", 1.0, None, None), ("many", at(5), 8, 13, "done", 5.0, None, None),
            ("last", at(300), 9, 1, "done", 1.0, None, None)]
    path = feed(spark, schema, rows[4:6], rows[6:8], rows[:4], rows[8:])
    got = ST.stream_poll_outcomes(spark, path, spark.read.parquet(path).schema, "10 minutes", "30 minutes", max_files=1)
    assert {r.doc_id: (r.outcome, r.attempt, r.content_score, r.lsi_keywords, r.decided_at) for r in got.collect()} == {
        "slow": ("timeout", None, None, [], at(10)), "good": ("done", 2, 0.0, ["t"], at(10)),
        "silent": ("timeout", None, None, [], at(11)), "many": ("timeout", None, None, [], at(10))}


def test_bounded_intake_forgets_what_the_exact_one_keeps(spark):
    def hook(i, minutes, article):
        return (i, f'{{"id":{article},"status":"draft","title":"t","blog_id":1}}', at(minutes))

    raw = [[hook(1, 0, 7), hook(2, 1, 8), hook(3, 2, 99)], [hook(4, 30, 7)], [hook(5, 300, 9)], [hook(6, 301, 11)],
           [hook(7, 302, 7), hook(8, 3, 10)]]  # 7 again after its state has gone; 10 five hours late
    schema = "delivery_id bigint, payload string, delivered_at timestamp_ntz"
    path = scratch_path(spark, "hooks")
    for rows in raw:
        spark.createDataFrame(rows, schema).withColumn("signature", hmac_sha256_base64(F.col("payload"), "s")) \
            .coalesce(1).write.mode("append").parquet(path)
    runs = spark.createDataFrame([("99",)], "article_id string")
    schema = spark.read.parquet(path).schema
    got = S.stream_intake_within(spark, path, schema, runs, "s", "1 hour", max_files=1).collect()
    assert sorted((r.delivery_id, r.article_id) for r in got) == [(1, "7"), (2, "8"), (5, "9"), (6, "11"), (7, "7")]
    exact = S.stream_draft_intake(spark, spark.read.parquet(path), runs, "s", max_files=1).collect()
    assert sorted((r.delivery_id, r.article_id) for r in exact) == [(1, "7"), (2, "8"), (5, "9"), (6, "11"), (8, "10")]


def files_of(spark, path):
    return set(spark.read.schema(RT.SCHEMA).parquet(f"{path}/table").inputFiles())


def test_a_merge_rewrites_touched_buckets_only_and_once(spark):
    columns = ", ".join(f"{n} {t}" for n, t in RUN_COLUMNS)
    rows = [tuple({"id": i, "article_id": str(i), "status": "failed", "title": "old"}.get(n) for n, _ in RUN_COLUMNS)
            for i in range(200)]
    path = scratch_path(spark, "runs")
    RT.create_run_table(spark.createDataFrame(rows, columns), path, 16)
    before = files_of(spark, path)
    changes = spark.createDataFrame(
        [("5", 1, "first", None), ("5", 2, None, 7.5), ("5", 3, "last", None), ("new", 1, "fresh", None)],
        "article_id string, seq int, title string, initial_surfer_score double")
    touched = RT.merge_batch(spark, path, changes, 0, at(0), buckets=16)
    assert 1 <= len(touched) <= 2
    after = files_of(spark, path)
    assert {f for f in before if not any(f"bucket={b}/" in f for b in touched)} == before & after

    def state():
        return {r.article_id: (r.id, r.status, r.title, r.initial_surfer_score, r.updated_at)
                for r in RT.read_run_table(spark, path).collect()}

    merged = state()
    assert merged["5"] == (5, "failed", "last", 7.5, at(0)) and merged["new"] == (200, "pending", "fresh", None, at(0))
    assert merged["6"] == (6, "failed", "old", None, None) and len(merged) == 201
    # the batch is run again: from its staged result, whatever the changes say now
    RT.merge_batch(spark, path, changes.limit(0), 0, at(9), buckets=16)
    assert state() == merged
    # it died after part of the buckets had been replaced
    RT._overwrite(spark.createDataFrame([(*[None] * len(RUN_COLUMNS), touched[0])], RT.SCHEMA), f"{path}/table")
    assert state() != merged
    RT.merge_batch(spark, path, changes, 0, at(0), buckets=16)
    assert state() == merged
    RT.merge_batch(spark, path, spark.createDataFrame([("more", 1)], "article_id string, seq int"), 1, at(1), buckets=16)
    assert state()["more"][0] == 201
    assert RT.merge_batch(spark, path, changes.limit(0), 2, at(2), buckets=16) == []


def test_published_batches_are_whole_and_repeatable(spark):
    root = scratch_path(spark, "out")
    one = spark.range(10).withColumn("x", F.lit("a"))
    schema = one.schema
    assert P.read_published(spark, root, schema).count() == 0
    assert P.publish(one, root, "b1") and not P.publish(one.limit(3), root, "b1")
    assert P.publish(spark.range(5).withColumn("x", F.lit("b")), root, "b2")
    got = P.read_published(spark, root, schema)
    assert {(r.batch, r["count"]) for r in got.groupBy("batch").count().collect()} == {("b1", 10), ("b2", 5)}
    assert P.manifest(spark, root, "b1")["rows"] == 10
    # a run that dies while it writes leaves nothing that is read
    boom = F.udf(lambda i: 1 // 0, "long")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        P.publish(one.withColumn("id", boom("id")), root, "b3")
    store, where = store_of(spark, f"{root}/b3")
    assert not store.exists(where) and P.read_published(spark, root, schema).count() == 15
