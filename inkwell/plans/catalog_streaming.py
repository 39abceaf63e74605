"""Streaming queries (T1-T3, and K1, A5, D1 as streams): the stream runs to
completion (availableNow) and its sink is returned; each is checked against a
batch oracle.  The feeds arrive in slices, a micro-batch each;
events reach their slice up to two days out of order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators import events as E
from inkwell.operators import scores as SC
from inkwell.operators.runs import MOVES
from inkwell.plans import catalog_events as CE
from inkwell.plans import catalog_runs as CR
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import ORACLES, register
from inkwell.sources import views as V
from inkwell.streaming import jobs as S
from inkwell.streaming import run_table as RT
from inkwell.streaming import state as ST

FILES = 2
DISORDER_HOURS = 48
DELAY = "3 days"
DELAY_MS = 3 * 24 * 3600 * 1000

# the staged feeds are small, so the limit is in files: several batches each
register("stream_draft_intake", ORACLES["idempotency_anti"])(
    lambda spark, sf: S.stream_draft_intake(spark, V.v_webhooks(spark, sf), V.v_runs(spark, sf),
                                            V.DEFAULT_STORE_SECRET, max_files=FILES))
register("stream_comment_routing", ORACLES["route_comment"])(
    lambda spark, sf: S.stream_comment_routing(spark, V.v_comment_events(spark, sf),
                                               V.v_stories(spark, sf), V.DEFAULT_TASKS_SECRET, max_files=FILES))


def _disordered(df: DataFrame, name: str) -> str:
    """The feed as it arrives up to ``DISORDER_HOURS`` after its events."""
    wait = F.pmod(F.xxhash64("event_id"), F.lit(DISORDER_HOURS)).cast("int")
    return S.stage_arrivals(df.withColumn("arrived", F.col("ts") + F.make_dt_interval(hours=wait)), "arrived", name)


@register("stream_run_state_machine", ORACLES["run_state_machine"])
def stream_run_state_machine(spark, sf):
    events = V.v_run_events(spark, sf)
    path = _disordered(events, "run-events")
    return ST.stream_state_machine(spark, path, events.schema, DELAY, max_files=S.files_a_slice(spark, path, S.ARRIVALS))


# --- bounded intake: once within the watermark --------------------------------
WITHIN = "1 hour"


@register("stream_intake_within", with_views(f"""
  SELECT article_id, count(*) AS accepted FROM (
    SELECT f.article_id, d.delivered_at,
           lag(d.delivered_at) OVER (PARTITION BY f.article_id ORDER BY d.delivered_at) AS before
    FROM ({CE.F1_SQL}) f JOIN v_deliveries d USING (delivery_id)
    WHERE NOT EXISTS (SELECT 1 FROM v_runs r WHERE r.article_id = f.article_id))
  WHERE before IS NULL OR delivered_at > before + INTERVAL 1 HOUR
  GROUP BY article_id""", "v_deliveries", "v_runs"))
def stream_intake_within(spark, sf):
    feed = V.v_deliveries(spark, sf)
    path = S.stage_arrivals(feed, "delivered_at", "deliveries")
    taken = S.stream_intake_within(spark, path, feed.schema, V.v_runs(spark, sf), V.DEFAULT_STORE_SECRET, WITHIN,
                                   max_files=S.files_a_slice(spark, path, S.ARRIVALS))
    return taken.groupBy("article_id").agg(F.count(F.lit(1)).alias("accepted"))


# --- K1 as a sink ---------------------------------------------------------------
CHANGE_SLICES = 3


def run_changes(spark, sf) -> DataFrame:
    """Changes of the run table with the slice they arrive in: accepted drafts
    (the first delivery of each article), the first score of every tenth article
    in slice 0 and its last score in slice 2."""
    drafts = E.idempotency_anti(E.draft_filter(CE.parsed_webhooks(spark, sf)), V.v_runs(spark, sf))
    number = F.col("article_id").cast("bigint")
    new = drafts.select((number % CHANGE_SLICES).cast("int").alias("slice"), F.col("delivery_id").alias("seq"),
                        "article_id", "blog_id", "title", F.col("body_html").alias("original_content"))
    scores = V.v_scores(spark, sf).where(number % 10 == 0).select(
        number.alias("seq"), (number * 2 + 1).cast("string").alias("article_id"), "initial", "final")
    first = scores.select(F.lit(0).alias("slice"), "seq", "article_id", F.col("initial").alias("initial_surfer_score"))
    last = scores.select(F.lit(CHANGE_SLICES - 1).alias("slice"), "seq", "article_id",
                         F.col("final").alias("final_surfer_score"))
    return new.unionByName(first, allowMissingColumns=True).unionByName(last, allowMissingColumns=True)


@register("stream_run_upsert", ORACLES["run_upsert"].replace(
    "row_number() OVER (ORDER BY article_id)",
    f"row_number() OVER (ORDER BY CAST(article_id AS BIGINT) % {CHANGE_SLICES}, article_id)"))
def stream_run_upsert(spark, sf):
    changes = run_changes(spark, sf)
    path = S.stage_slices(changes, F.col("slice"), "run-changes", CHANGE_SLICES)
    return RT.stream_run_upsert(spark, V.v_runs(spark, sf), path, changes.schema, CR.NOW, buckets=8,
                                max_files=S.files_a_slice(spark, path, CHANGE_SLICES))


# --- deadlines --------------------------------------------------------------------
BUDGET_HOURS = 36
STALE_MINUTES = 360


@register("stream_poll_outcomes", with_views(f"""
  SELECT * FROM (WITH mark AS (SELECT epoch_ms(max(ts)) - {DELAY_MS} AS passed FROM v_polls),
  w AS (
    SELECT doc_id, min(ts) AS opened,
           min(ts) FILTER (WHERE status = 'done' AND attempt <= {SC.POLL_MAX_ATTEMPTS}) AS done
    FROM v_polls GROUP BY doc_id),
  o AS (
    SELECT doc_id, coalesce(done <= opened + INTERVAL {BUDGET_HOURS} HOUR, FALSE) AS ok, done,
           opened + INTERVAL {BUDGET_HOURS} HOUR AS deadline FROM w)
  SELECT o.doc_id, CASE WHEN ok THEN 'done' ELSE 'timeout' END AS outcome, p.attempt,
         CASE WHEN ok THEN coalesce(p.content_score, 0.0) END AS content_score,
         coalesce(p.lsi_keywords, []) AS lsi_keywords, coalesce(p.suggested_headings, []) AS suggested_headings,
         CASE WHEN ok THEN done ELSE deadline END AS decided_at
  FROM o LEFT JOIN v_polls p ON ok AND p.doc_id = o.doc_id AND p.ts = o.done
  WHERE epoch_ms(CASE WHEN ok THEN done ELSE deadline END) < (SELECT passed FROM mark))""", "v_polls"))
def stream_poll_outcomes(spark, sf):
    polls = V.v_polls(spark, sf)
    path = _disordered(polls, "polls")
    return ST.stream_poll_outcomes(spark, path, polls.schema, f"{BUDGET_HOURS} hours", DELAY,
                                   max_files=S.files_a_slice(spark, path, S.ARRIVALS))


_PENDING_MOVES = ", ".join(f"'{a}'" for a, m in MOVES.items() if "pending" in m)


@register("stream_stale_runs", with_views(f"""
  SELECT * FROM (WITH mark AS (SELECT epoch_ms(max(ts)) - {DELAY_MS} AS passed FROM v_run_events
                WHERE action = 'created' OR action IN ({_PENDING_MOVES})),
  c AS (SELECT article_id, min(ts) AS created_at FROM v_run_events WHERE action = 'created' GROUP BY article_id)
  SELECT article_id, created_at, created_at + INTERVAL {STALE_MINUTES} MINUTE AS stale_at FROM c
  WHERE epoch_ms(created_at + INTERVAL {STALE_MINUTES} MINUTE) < (SELECT passed FROM mark)
    AND NOT EXISTS (SELECT 1 FROM v_run_events e WHERE e.article_id = c.article_id AND e.action IN ({_PENDING_MOVES})
                    AND e.ts >= c.created_at AND e.ts <= c.created_at + INTERVAL {STALE_MINUTES} MINUTE))""", "v_run_events"))
def stream_stale_runs(spark, sf):
    events = V.v_run_events(spark, sf)
    path = _disordered(events, "stale")
    return ST.stream_stale_runs(spark, path, events.schema, f"{STALE_MINUTES} minutes", DELAY,
                                max_files=S.files_a_slice(spark, path, S.ARRIVALS))
