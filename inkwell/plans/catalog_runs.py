"""Run-table queries (S9, J3, J4, F8, F9, R1, K1, K5, K6, D1, T3 batch,
X13, X16, X17)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from inkwell.operators import events as E
from inkwell.operators import reports as R
from inkwell.operators import runs as RU
from inkwell.plans import catalog_events as CE
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import ORACLES, register
from inkwell.session import scratch_path
from inkwell.sources import views as V
from inkwell.sources.published import published

AS_OF = dt.datetime(1998, 8, 2, 0, 0, 0)
WRITEBACK_ERROR = "the store answered 503"  # of the staged store
NOW = dt.datetime(2026, 1, 1, 0, 0, 0)
_RUN_COLS = ", ".join(n for n, _ in V.RUN_COLUMNS)


def _iso(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN strftime({c}, '%f') = '000000' "
            f"THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")


_HISTORY = ", ".join(_iso(c) + f" AS {c}" if c in ("created_at", "completed_at") else c for c in RU.HISTORY_COLUMNS)


@register("run_scan", with_views(f"SELECT {_RUN_COLS} FROM v_runs", "v_runs"))
def run_scan(spark, sf):
    path = scratch_path(spark, "run-table")
    V.v_runs(spark, sf).write.parquet(path)
    return RU.run_scan(spark, path)


@register("run_by_article", with_views(f"""
  SELECT w.delivery_id, w.article_id, r.id AS run_id, r.status
  FROM ({CE.S2_SQL}) w JOIN v_runs r USING (article_id)""", "v_webhooks", "v_runs"))
def run_by_article(spark, sf):
    w = CE.parsed_webhooks(spark, sf).select("delivery_id", "article_id")
    return RU.run_by_article(w, V.v_runs(spark, sf))


_J4 = f"""
  SELECT c.story_gid, c.task_gid, c.decision, c.reason, r.run_id, r.article_id, r.status
  FROM ({CE.X18_SQL}) c JOIN (
    SELECT asana_task_gid AS task_gid, arg_min(id, id) AS run_id, arg_min(article_id, id) AS article_id,
           arg_min(status, id) AS status
    FROM v_runs WHERE asana_task_gid IS NOT NULL GROUP BY asana_task_gid) r USING (task_gid)
"""


def _j4(spark, sf):
    c = CE.routed_comments(spark, sf).select("story_gid", "task_gid", "decision", "reason")
    return RU.run_by_task(c, V.v_runs(spark, sf))


@register("run_by_task", with_views(_J4, "v_comment_events", "v_stories", "v_runs"))
def run_by_task(spark, sf):
    return _j4(spark, sf)


@register("approval_guard", with_views(
    f"SELECT * FROM ({_J4}) WHERE decision = 'approve' AND status = 'awaiting_approval'",
    "v_comment_events", "v_stories", "v_runs"))
def approval_guard(spark, sf):
    return RU.approval_guard(_j4(spark, sf))


@register("task_action_rows", with_views(f"""
  SELECT task_gid, outcome,
         CASE outcome WHEN 'completed' THEN '{R.WRITEBACK_OK_COMMENT}'
                      WHEN 'writeback_failed' THEN printf('{R.WRITEBACK_FAILED_COMMENT.replace(chr(39), chr(39) * 2).replace(chr(10), "' || chr(10) || '")}', '{WRITEBACK_ERROR}')
                      ELSE printf('{R.REJECTED_COMMENT.replace(chr(39), chr(39) * 2).replace(chr(10), "' || chr(10) || '")}', reason) END AS comment,
         outcome = 'completed' AS complete_task
  FROM (SELECT task_gid, reason,
               CASE WHEN decision = 'approve' AND status = 'awaiting_approval'
                    THEN CASE WHEN CAST(story_gid AS BIGINT) % 3 = 0 THEN 'writeback_failed' ELSE 'completed' END
                    WHEN decision = 'reject' THEN 'rejected' END AS outcome FROM ({_J4}))
  WHERE outcome IS NOT NULL""", "v_comment_events", "v_stories", "v_runs"))
def task_action_rows(spark, sf):
    d = _j4(spark, sf)
    # the staged store refuses every third write-back
    refused = F.col("story_gid").cast("bigint") % 3 == 0
    outcome = (F.when((F.col("decision") == "approve") & (F.col("status") == "awaiting_approval"),
                      F.when(refused, "writeback_failed").otherwise("completed"))
               .when(F.col("decision") == "reject", "rejected"))
    return R.task_action_rows(d.withColumn("outcome", outcome).withColumn(
        "error", F.when(outcome == "writeback_failed", F.lit(WRITEBACK_ERROR))))


@register("run_history_projection", with_views(f"SELECT {_HISTORY} FROM v_runs", "v_runs"))
def run_history_projection(spark, sf):
    return RU.run_history_projection(V.v_runs(spark, sf))


@register("runs_last_50", with_views(
    f"SELECT {_HISTORY} FROM (SELECT * FROM v_runs ORDER BY created_at DESC, id DESC LIMIT {RU.HISTORY_LIMIT})",
    "v_runs"))
def runs_last_50(spark, sf):
    return RU.runs_last(V.v_runs(spark, sf))


@register("stale_pending_runs", with_views(f"""
  SELECT id, article_id, created_at FROM v_runs
  WHERE status = 'pending' AND created_at < TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL 60 MINUTE""", "v_runs"))
def stale_pending_runs(spark, sf):
    return RU.stale_pending_runs(V.v_runs(spark, sf), AS_OF, 60)


@register("failure_task_rows", with_views(f"""
  SELECT article_id, '{R.FAILURE_TITLE_PREFIX}' || coalesce(nullif(coalesce(title, ''), ''), article_id) AS task_title,
         printf('{R.FAILURE_NOTES.replace(chr(39), chr(39) * 2).replace(chr(10), "' || chr(10) || '")}', coalesce(title, ''), article_id,
                coalesce(failure_reason, '')) AS notes
  FROM v_runs WHERE status = 'failed'""", "v_runs"))
def failure_task_rows(spark, sf):
    return R.failure_task_rows(V.v_runs(spark, sf))


@register("next_business_day", with_views("""
  SELECT id, CAST(created_at AS DATE) AS created,
         CASE isodow(CAST(created_at AS DATE)) WHEN 5 THEN CAST(created_at AS DATE) + 3
              WHEN 6 THEN CAST(created_at AS DATE) + 2 ELSE CAST(created_at AS DATE) + 1 END AS due_on
  FROM v_runs""", "v_runs"))
def next_business_day(spark, sf):
    r = V.v_runs(spark, sf)
    d = F.to_date("created_at")
    return r.select("id", d.alias("created"), R.next_business_day(d).alias("due_on"))


@register("iso_timestamp", with_views(f"SELECT event_id, {_iso('ts')} AS ts_iso FROM v_run_events", "v_run_events"))
def iso_timestamp(spark, sf):
    e = V.v_run_events(spark, sf)
    return e.select("event_id", R.iso_timestamp("ts").alias("ts_iso"))


@register("duration_seconds", with_views("""
  SELECT article_id, started, gate, (epoch_us(gate) - epoch_us(started)) / 1e6 AS duration_seconds
  FROM (SELECT article_id, min(ts) FILTER (WHERE action = 'started') AS started,
               min(ts) FILTER (WHERE action = 'scored') AS gate
        FROM v_run_events GROUP BY article_id)
  WHERE started IS NOT NULL AND gate >= started""", "v_run_events"))
def duration_seconds(spark, sf):
    e = V.v_run_events(spark, sf)
    g = e.groupBy("article_id").agg(
        F.min(F.when(F.col("action") == "started", F.col("ts"))).alias("started"),
        F.min(F.when(F.col("action") == "scored", F.col("ts"))).alias("gate"))
    return g.where(F.col("started").isNotNull() & (F.col("gate") >= F.col("started"))).select(
        "article_id", "started", "gate", R.seconds_between("started", "gate").alias("duration_seconds"))


_STATE_CASE = """CASE
      WHEN x = 'created' AND st = 'none' THEN 'pending'
      WHEN x = 'started' AND st = 'pending' THEN 'processing'
      WHEN x = 'scored' AND st = 'processing' THEN 'awaiting_approval'
      WHEN x = 'failed' AND st IN ('pending', 'processing') THEN 'failed'
      WHEN x = 'approve' AND st = 'awaiting_approval' THEN 'completed'
      WHEN x = 'reject' AND st <> 'none' THEN 'rejected'
      ELSE st END"""


@register("run_state_machine", with_views(f"""
  SELECT article_id, status, CASE WHEN status = 'rejected' THEN 'Rejected: ' || coalesce(reason, '') END AS failure_reason FROM (
    SELECT article_id, list_reduce(list(action ORDER BY ts, event_id), lambda st, x: {_STATE_CASE}, 'none') AS status,
           (list(reason ORDER BY ts DESC, event_id DESC) FILTER (WHERE action = 'reject'))[1] AS reason
    FROM v_run_events GROUP BY article_id)
  WHERE status <> 'none'""", "v_run_events"))
def run_state_machine(spark, sf):
    return RU.run_state_machine(V.v_run_events(spark, sf))


@register("run_upsert", with_views(f"""SELECT * FROM (
  WITH intake AS ({CE.F1_SQL}),
  fresh AS (SELECT * FROM intake QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY delivery_id) = 1),
  new_rows AS (SELECT f.article_id, f.blog_id, f.title, f.body_html FROM fresh f
               WHERE NOT EXISTS (SELECT 1 FROM v_runs r WHERE r.article_id = f.article_id)),
  upd AS (SELECT CAST(CAST(article_id AS BIGINT) * 2 + 1 AS VARCHAR) AS article_id, initial, final
          FROM v_scores WHERE CAST(article_id AS BIGINT) % 10 = 0)
  SELECT r.id, r.article_id, r.blog_id, r.title, r.language, r.status, r.target_keyword_input, r.main_keyword,
         coalesce(u.initial, r.initial_surfer_score) AS initial_surfer_score,
         coalesce(u.final, r.final_surfer_score) AS final_surfer_score,
         r.score_delta, r.score_delta_pct, r.plagiarism_flagged, r.plagiarism_max_similarity,
         r.original_content, r.optimized_content, r.optimized_metadata, r.failure_reason, r.asana_task_gid,
         r.surfer_doc_id, r.created_at,
         CASE WHEN u.article_id IS NOT NULL THEN TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' ELSE r.updated_at END AS updated_at,
         r.completed_at, r.duration_seconds
  FROM v_runs r LEFT JOIN upd u USING (article_id)
  UNION ALL
  SELECT (SELECT max(id) FROM v_runs) + row_number() OVER (ORDER BY article_id) AS id, article_id, blog_id, title,
         NULL, 'pending', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, body_html, NULL, NULL, NULL, NULL, NULL,
         TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}', TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}', NULL, NULL
  FROM new_rows)""", "v_webhooks", "v_runs", "v_scores"))
def run_upsert(spark, sf):
    runs = V.v_runs(spark, sf)
    intake = E.idempotency_anti(E.draft_filter(CE.parsed_webhooks(spark, sf)), runs).select(
        "article_id", "blog_id", "title", F.col("body_html").alias("original_content"))
    upd = V.v_scores(spark, sf).where(F.col("article_id").cast("bigint") % 10 == 0).select(
        (F.col("article_id").cast("bigint") * 2 + 1).cast("string").alias("article_id"), F.col("initial").alias("initial_surfer_score"), F.col("final").alias("final_surfer_score"))
    changes = intake.unionByName(upd, allowMissingColumns=True)
    return RU.run_upsert(runs, changes, NOW)


# --- K4 / X15: approval task rows with the report text ------------------------
from inkwell.operators import competitors as C  # noqa: E402
from inkwell.operators import keywords as K  # noqa: E402
from inkwell.operators import responses as RS  # noqa: E402
from inkwell.operators import scores as S  # noqa: E402
from inkwell.plans import catalog_competitors, catalog_responses as CR  # noqa: E402,F401
from inkwell.plans import catalog_keywords as CK  # noqa: E402
from inkwell.plans.catalog_scores import _SIM_VALUE  # noqa: E402


def _tmpl(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _report_input(spark, sf):
    runs = V.v_runs(spark, sf).where(F.col("status") == "awaiting_approval")
    sc = S.score_delta(V.v_scores(spark, sf)).select(
        F.col("article_id").cast("bigint").alias("id"), F.col("initial").alias("initial_score"),
        F.col("final").alias("final_score"), "score_delta_pct")
    sim = S.max_similarity_flag(V.v_scores(spark, sf).select("article_id"), V.v_matches(spark, sf)).select(
        F.col("article_id").cast("bigint").alias("id"), F.col("max_similarity").alias("plagiarism_max_similarity"),
        "plagiarism_flagged")
    ov = K.main_keyword(K.keyword_overview_parse(V.v_overview_reports(spark, sf))).select(
        F.col("report_id").alias("id"), "main_keyword", "main_kw_volume", "main_kw_difficulty")
    return (runs.select("id", "article_id", "title", "created_at").join(sc, "id", "left").join(sim, "id", "left")
            .join(ov, "id", "left")
            .withColumn("main_keyword", F.coalesce("main_keyword", F.lit("")))
            .join(_used_urls(spark, sf), "article_id", "left").join(_rewrites(spark, sf), "article_id", "left"))


def _used_urls(spark, sf):
    """Competitor URLs of each article's keyword."""
    a = V.v_articles(spark, sf).select("article_id", F.col("target_keyword").alias("keyword")).where("keyword is not null")
    top = C.competitor_links(C.search_results_scan(V.v_serp_responses(spark, sf)))
    s = C.competitor_structure(a.select("keyword"), top, C.fetch_competitors(top, V.v_web(spark, sf)))
    return a.join(s.select("keyword", "competitor_urls"), "keyword").select("article_id", "competitor_urls")


def _rewrites(spark, sf):
    """Summary and link suggestions of each valid rewrite."""
    return RS.parse_responses(V.v_responses(spark, sf)).where("valid").select(
        "article_id", "changes_summary", "internal_link_suggestions")


_K4 = f"""
  SELECT article_id, '{R.APPROVAL_TITLE_PREFIX}' || coalesce(title, 'None') AS task_title,
         printf({_tmpl(R.REPORT_TEMPLATE)}, coalesce(title, 'None'), main_keyword, printf('%,d', vol),
                printf('%.0f', diff), printf('%.0f', ini), printf('%.0f', fin),
                CASE WHEN pct >= 0 THEN '+' ELSE '' END, printf('%.1f', pct),
                CASE WHEN coalesce(urls, '') = '' THEN 'N/A' ELSE replace(urls, ' ', ', ') END,
                CASE WHEN flagged THEN printf({_tmpl(R.SIMILARITY_YES)}, printf('%.1f', sim))
                     ELSE printf({_tmpl(R.SIMILARITY_NO)}, printf('%.1f', sim)) END,
                coalesce(summary, ''), coalesce(links_text, '{R.NO_LINKS}')) AS notes,
         CASE isodow(CAST(created_at AS DATE)) WHEN 5 THEN CAST(created_at AS DATE) + 3
              WHEN 6 THEN CAST(created_at AS DATE) + 2 ELSE CAST(created_at AS DATE) + 1 END AS due_on
  FROM (
    SELECT r.article_id, r.title, r.created_at, coalesce(ov.main_keyword, '') AS main_keyword,
           coalesce(ov.volume, 0) AS vol, coalesce(ov.difficulty, 0.0) AS diff,
           coalesce(s.initial, 0.0) AS ini, coalesce(s.final, 0.0) AS fin,
           coalesce(CASE WHEN coalesce(s.initial, 0.0) <> 0 THEN (s.final - s.initial) / s.initial * 100 ELSE 0.0 END, 0.0) AS pct,
           coalesce(m.mx, 0.0) AS sim, coalesce(m.mx, 0.0) > {S.SIMILARITY_THRESHOLD} AS flagged,
           c.competitor_urls AS urls, p.changes_summary AS summary, l.links_text
    FROM v_runs r
    LEFT JOIN v_articles a ON a.article_id = r.article_id
    LEFT JOIN ({ORACLES['competitor_fallback']}) c ON c.keyword = a.target_keyword
    LEFT JOIN (SELECT * FROM ({CR._PARSED}) WHERE valid) p ON p.article_id = r.article_id
    LEFT JOIN (SELECT * FROM ({ORACLES['format_internal_links']})) l ON l.article_id = p.article_id
    LEFT JOIN v_scores s ON CAST(s.article_id AS BIGINT) = r.id
    LEFT JOIN (SELECT article_id, max({_SIM_VALUE}) AS mx FROM v_matches GROUP BY article_id) m
           ON CAST(m.article_id AS BIGINT) = r.id
    LEFT JOIN (SELECT report_id, coalesce(nullif(keyword, ''), seed) AS main_keyword, volume, difficulty
               FROM ({CK._OVERVIEW})) ov ON ov.report_id = r.id
    WHERE r.status = 'awaiting_approval')
"""


@register("approval_task_rows", with_views(
    _K4, "v_runs", "v_scores", "v_matches", "v_overview_reports", "v_articles", "v_responses"))
def approval_task_rows(spark, sf):
    return published(R.approval_task_rows(_report_input(spark, sf), F.to_date("created_at")), "approval-tasks")
