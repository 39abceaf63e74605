"""Streams with keyed state and event-time timers (SURVEY 2.9 T3; 2.5 A5;
2.12 D1).

Files may overlap in time and come in any order.  A watermark of ``delay`` says
how late an event may be.  The state of a key is what earlier events leave
behind; an event-time timer calls the key again when the watermark has passed
the time it waits for, whether or not another event of the key comes.

* T3 keeps the status up to the watermark and the few events beyond it, in
  order.  What it emits is the status after all events so far, so the last
  record of an article is its current status, whatever the order of files.
* A5 and D1 are deadlines: something opens a wait (the first poll, the creation
  of a run), something may close it in time (a finished score, any further
  step), otherwise the timer raises the timeout.

Spark drops events later than ``delay``.  Nothing gets lost for that: T3 counts
the events of every article, and ``stream_state_machine`` folds the articles
whose count differs from the feed's again, in batch form.

Scale: the events of a key meet in one task, a micro-batch at a time; its state
holds a status and at most ``delay`` worth of events (T3), or one wait (A5, D1).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from inkwell.operators.runs import MOVES, REJECTED_REASON, run_state_machine
from inkwell.operators.scores import POLL_MAX_ATTEMPTS
from inkwell.streaming.jobs import read_feed, read_sink, run_stream

_STATE = ("status string, reject string, rejected_at bigint, rejected_id bigint, n bigint, "
          "ts array<bigint>, id array<bigint>, action array<string>, reason array<string>")


def _after(status: str, reject: tuple, events: list[tuple]) -> tuple[str, tuple]:
    """Status and last rejection (ts, id, reason) after ``events`` in order."""
    for ts, i, action, reason in events:
        status = MOVES.get(action, {}).get(status, status)
        if action == "reject":
            reject = max(reject, (ts, i, reason), key=lambda r: r[:2])
    return status, reject


def run_status_step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One micro-batch of an article: fold what the watermark has passed, keep
    the rest, emit the status after all of it."""
    if state.exists:
        status, reason, at, ident, n, *kept = state.get
        reject, waiting = (at, ident, reason), list(zip(*kept))
    else:
        status, reject, n, waiting = "none", (-1, -1, None), 0, []
    fresh = [r for f in frames for r in zip(f["us"].tolist(), f["event_id"].tolist(), f["action"], f["reason"])] \
        if not state.hasTimedOut else []
    passed = state.getCurrentWatermarkMs() * 1000
    waiting = sorted(waiting + fresh, key=lambda r: r[:2])
    done = sum(r[0] <= passed for r in waiting)
    status, reject = _after(status, reject, waiting[:done])
    waiting, n = waiting[done:], n + len(fresh)
    columns = [list(c) for c in zip(*waiting)] or [[], [], [], []]
    state.update((status, reject[2], reject[0], reject[1], n, *columns))
    if waiting:
        state.setTimeoutTimestamp(max(waiting[0][0] // 1000, passed // 1000) + 1)
    if fresh:
        status, reject = _after(status, reject, waiting)
        why = REJECTED_REASON % (reject[2] or "") if status == "rejected" else None
        yield pd.DataFrame({"article_id": [key[0]], "status": [status], "failure_reason": [why], "n": [n]})


def stream_state_machine(spark: SparkSession, path: str, schema, delay: str = "1 day",
                         max_files: int | None = None) -> DataFrame:
    """T3 (stream): (article_id, status, failure_reason) after all events of the
    feed at ``path``.  Articles with an event later than ``delay`` are folded
    from the feed, so the result is the batch form's at any order of files."""
    feed = read_feed(spark, path, schema, max_files).select(
        "article_id", "event_id", "action", "reason", F.col("ts").cast("timestamp").alias("ts"))
    statuses = (feed.withWatermark("ts", delay).withColumn("us", F.unix_micros("ts")).groupBy("article_id")
                .applyInPandasWithState(run_status_step, "article_id string, status string, failure_reason string, n bigint",
                                        _STATE, "update", GroupStateTimeout.EventTimeTimeout))
    sink = run_stream(statuses, "run-state", lambda b: b, "update")
    last = read_sink(spark, sink, "article_id string, status string, failure_reason string, n bigint, _batch bigint") \
        .groupBy("article_id").agg(F.max_by(F.struct("status", "failure_reason", "n"), "_batch").alias("s"))
    events = spark.read.schema(schema).parquet(path)
    counted = events.groupBy("article_id").agg(F.count(F.lit(1)).alias("events")).join(last, "article_id", "left")
    whole = F.coalesce(F.col("s.n"), F.lit(0)) == F.col("events")
    late = run_state_machine(events.join(counted.where(~whole).select("article_id"), "article_id", "left_semi"))
    return counted.where(whole).select("article_id", "s.status", "s.failure_reason").where("status <> 'none'") \
        .unionByName(late)


_WAIT = "settled boolean, opened bigint, opened_seq bigint, ts array<bigint>, seq array<bigint>, payload array<string>"
_OUTCOME = "key string, outcome string, opened_us bigint, decided_us bigint, payload string"


def wait_step(after_us: int) -> Callable:
    """Step of a wait: the first ``opens`` event of a key starts it, the first
    ``closes`` event from then on ends it if it comes within ``after_us``,
    otherwise it expires.  The outcome is emitted once, when the watermark has
    passed the moment that decides it, so that no earlier event can come."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        settled, opened, closes = False, None, []
        if state.exists:
            settled, at, seq, *kept = state.get
            opened, closes = None if at is None else (at, seq), list(zip(*kept))
        if settled:
            return
        if not state.hasTimedOut:
            for f in frames:
                for us, seq, opens, ends, payload in zip(f["us"].tolist(), f["seq"].tolist(), f["opens"], f["closes"], f["payload"]):
                    if opens and (opened is None or (us, seq) < opened):
                        opened = (us, seq)
                    if ends:
                        closes.append((us, seq, payload))
        passed = state.getCurrentWatermarkMs() * 1000
        closes.sort(key=lambda r: r[:2])
        due = None
        if opened:
            # an earlier opening may still come, so closes before this one stay; of the others the first counts
            after = [c for c in closes if c[:2] >= opened][:1]
            closes = [c for c in closes if c[:2] < opened and c[0] > passed] + after
            end = after[0] if after and after[0][0] <= opened[0] + after_us else None
            due = end[0] if end else opened[0] + after_us
            if due <= passed:
                yield pd.DataFrame({"key": [key[0]], "outcome": ["closed" if end else "expired"], "opened_us": [opened[0]],
                                    "decided_us": [due], "payload": [end[2] if end else None]})
                state.update((True, None, None, [], [], []))
                return
        else:
            closes = [c for c in closes if c[0] > passed]  # no opening can come before them
            due = closes[-1][0] if closes else None
        if due is None:
            state.remove()
            return
        state.update((False, *(opened or (None, None)), *([list(c) for c in zip(*closes)] or [[], [], []])))
        state.setTimeoutTimestamp(max(due // 1000, passed // 1000) + 1)

    return step


def stream_waits(spark: SparkSession, path: str, schema, name: str, key: str, seq: str, opens: Column, closes: Column,
                 payload: Column, after: str, delay: str, max_files: int | None = None) -> DataFrame:
    """(key, outcome, opened, decided, payload) of the waits in the feed at
    ``path`` (event time ``ts``) that the final watermark decides; ``after`` and
    ``delay`` are intervals such as ``36 hours``."""
    micros = spark.sql(f"SELECT timestampdiff(MICROSECOND, TIMESTAMP '2000-01-01', "
                       f"TIMESTAMP '2000-01-01' + INTERVAL {after})").first()[0]
    feed = read_feed(spark, path, schema, max_files)
    marked = feed.where(opens | closes).select(
        F.col(key).alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col(seq).cast("bigint").alias("seq"),
        opens.alias("opens"), closes.alias("closes"), payload.alias("payload"))
    found = (marked.withWatermark("ts", delay).withColumn("us", F.unix_micros("ts")).groupBy("key")
             .applyInPandasWithState(wait_step(micros), _OUTCOME, _WAIT, "append", GroupStateTimeout.EventTimeTimeout))
    out = read_sink(spark, run_stream(found, name, lambda b: b), _OUTCOME)
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("key", "outcome", at("opened_us").alias("opened"), at("decided_us").alias("decided"), "payload")


def stream_poll_outcomes(spark: SparkSession, path: str, schema, budget: str = "60 seconds", delay: str = "1 day",
                         max_attempts: int = POLL_MAX_ATTEMPTS, max_files: int | None = None) -> DataFrame:
    """A5 in event time: a document's first poll opens the wait; the first
    finished score within ``max_attempts`` and ``budget`` ends it, otherwise the
    timer raises the timeout, though no later poll comes."""
    done = F.coalesce((F.col("status") == "done") & (F.col("attempt") <= max_attempts), F.lit(False))
    fields = ("attempt", "content_score", "lsi_keywords", "suggested_headings")
    out = stream_waits(spark, path, schema, "polls", "doc_id", "event_id", F.lit(True), done,
                       F.when(done, F.to_json(F.struct(*fields))), budget, delay, max_files)
    none = F.array().cast("array<string>")
    p = F.from_json("payload", "attempt int, content_score double, lsi_keywords array<string>, suggested_headings array<string>")
    return out.withColumn("_p", p).select(
        F.col("key").alias("doc_id"), F.when(F.col("outcome") == "closed", "done").otherwise("timeout").alias("outcome"),
        F.col("_p.attempt").alias("attempt"),
        F.when(F.col("outcome") == "closed", F.coalesce("_p.content_score", F.lit(0.0))).alias("content_score"),
        F.coalesce("_p.lsi_keywords", none).alias("lsi_keywords"),
        F.coalesce("_p.suggested_headings", none).alias("suggested_headings"), F.col("decided").alias("decided_at"))


def stream_stale_runs(spark: SparkSession, path: str, schema, after: str = "60 minutes", delay: str = "1 day",
                      max_files: int | None = None) -> DataFrame:
    """D1 in event time: runs that are still pending ``after`` their creation,
    raised by the timer (any event that moves a pending run ends the wait)."""
    moves = [a for a, m in MOVES.items() if "pending" in m]
    out = stream_waits(spark, path, schema, "stale", "article_id", "event_id", F.col("action") == "created",
                       F.col("action").isin(moves), F.lit(None).cast("string"), after, delay, max_files)
    return out.where("outcome = 'expired'").select(
        F.col("key").alias("article_id"), F.col("opened").alias("created_at"), F.col("decided").alias("stale_at"))
