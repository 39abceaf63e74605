"""Event-feed queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import events as E
from inkwell.plans.oracle_views import sql_hmac_base64, sql_hmac_hex, with_views
from inkwell.plans.registry import register
from inkwell.sources import views as V

STORE_SECRET = V.DEFAULT_STORE_SECRET
TASKS_SECRET = V.DEFAULT_TASKS_SECRET
BLOG_ID = "1"

_F3 = f"SELECT * FROM v_webhooks WHERE signature = {sql_hmac_base64('payload', STORE_SECRET)}"
_S2 = f"""
  SELECT delivery_id, json_extract_string(payload, '$.id') AS article_id,
         json_extract_string(payload, '$.title') AS title,
         json_extract_string(payload, '$.status') AS status,
         json_extract_string(payload, '$.blog_id') AS blog_id,
         coalesce(json_extract_string(payload, '$.body_html'), '') AS body_html
  FROM ({_F3}) WHERE json_valid(payload) AND json_extract_string(payload, '$.id') IS NOT NULL
"""
_F1 = f"SELECT * FROM ({_S2}) WHERE status = 'draft'"
_U2 = f"SELECT * FROM ({_F1}) QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY delivery_id) = 1"

_F4 = f"SELECT * FROM v_comment_events WHERE signature = {sql_hmac_hex('payload', TASKS_SECRET)}"
_S3 = f"""
  SELECT delivery_id, CAST(i - 1 AS INTEGER) AS event_no,
         coalesce(json_extract_string(e, '$.action'), '') AS action,
         coalesce(json_extract_string(e, '$.resource.resource_type'), '') AS resource_type,
         coalesce(json_extract_string(e, '$.resource.gid'), '') AS story_gid,
         coalesce(json_extract_string(e, '$.parent.gid'), '') AS task_gid
  FROM (SELECT delivery_id, unnest(ev) AS e, generate_subscripts(ev, 1) AS i
        FROM (SELECT delivery_id, CAST(json_extract(payload, '$.events') AS JSON[]) AS ev
              FROM ({_F4}) WHERE json_valid(payload)))
"""
_F5 = f"SELECT * FROM ({_S3}) WHERE resource_type = 'story' AND action = 'added' AND story_gid <> '' AND task_gid <> ''"
_J5 = f"""
  SELECT e.*, regexp_replace(coalesce(s.text, ''), '^\\s+|\\s+$', '', 'g') AS comment_text
  FROM ({_F5}) e JOIN v_stories s USING (story_gid)
  WHERE regexp_replace(coalesce(s.text, ''), '^\\s+|\\s+$', '', 'g') <> ''
"""
_X18 = f"""
  SELECT delivery_id, event_no, story_gid, task_gid, comment_text, decision,
         CASE WHEN decision = 'reject' THEN coalesce(nullif(
           regexp_replace(regexp_replace(substr(comment_text, 7), '^[: ]+', ''), '^\\s+|\\s+$', '', 'g'), ''),
           '{E.NO_REASON}') END AS reason
  FROM (SELECT *, CASE WHEN starts_with(upper(comment_text), 'APPROVE') THEN 'approve'
                       WHEN starts_with(upper(comment_text), 'REJECT') THEN 'reject' END AS decision
        FROM ({_J5}))
  WHERE decision IS NOT NULL
"""

S2_SQL, F1_SQL, X18_SQL = _S2, _F1, _X18


def parsed_webhooks(spark, sf):
    return E.webhook_parse(E.signature_filter_base64(V.v_webhooks(spark, sf), STORE_SECRET))


def routed_comments(spark, sf):
    ev = E.comment_event_filter(E.comment_event_explode(
        E.signature_filter_hex(V.v_comment_events(spark, sf), TASKS_SECRET)))
    return E.route_comment(E.story_text_join(ev, V.v_stories(spark, sf)))


@register("signature_filter_base64", with_views(f"SELECT delivery_id FROM ({_F3})", "v_webhooks"))
def signature_filter_base64(spark, sf):
    return E.signature_filter_base64(V.v_webhooks(spark, sf), STORE_SECRET).select("delivery_id")


@register("webhook_parse", with_views(_S2, "v_webhooks"))
def webhook_parse(spark, sf):
    return parsed_webhooks(spark, sf)


@register("draft_filter", with_views(f"SELECT delivery_id, article_id, status FROM ({_F1})", "v_webhooks"))
def draft_filter(spark, sf):
    return E.draft_filter(parsed_webhooks(spark, sf)).select("delivery_id", "article_id", "status")


@register("blog_filter", with_views(
    f"SELECT delivery_id, article_id, blog_id FROM ({_F1}) WHERE blog_id = '{BLOG_ID}'", "v_webhooks"))
def blog_filter(spark, sf):
    return E.blog_filter(E.draft_filter(parsed_webhooks(spark, sf)), BLOG_ID).select(
        "delivery_id", "article_id", "blog_id")


@register("article_dedup", with_views(f"SELECT delivery_id, article_id FROM ({_U2})", "v_webhooks"))
def article_dedup(spark, sf):
    return E.first_per_article(E.draft_filter(parsed_webhooks(spark, sf))).select("delivery_id", "article_id")


@register("idempotency_anti", with_views(f"""
  SELECT delivery_id, article_id FROM ({_U2}) u
  WHERE NOT EXISTS (SELECT 1 FROM v_runs r WHERE r.article_id = u.article_id)""", "v_webhooks", "v_runs"))
def idempotency_anti(spark, sf):
    return E.idempotency_anti(E.draft_filter(parsed_webhooks(spark, sf)), V.v_runs(spark, sf)).select(
        "delivery_id", "article_id")


@register("signature_filter_hex", with_views(f"SELECT delivery_id FROM ({_F4})", "v_comment_events"))
def signature_filter_hex(spark, sf):
    return E.signature_filter_hex(V.v_comment_events(spark, sf), TASKS_SECRET).select("delivery_id")


@register("comment_event_explode", with_views(_S3, "v_comment_events"))
def comment_event_explode(spark, sf):
    return E.comment_event_explode(E.signature_filter_hex(V.v_comment_events(spark, sf), TASKS_SECRET))


@register("comment_event_filter", with_views(_F5, "v_comment_events"))
def comment_event_filter(spark, sf):
    return E.comment_event_filter(E.comment_event_explode(
        E.signature_filter_hex(V.v_comment_events(spark, sf), TASKS_SECRET)))


@register("story_text_join", with_views(_J5, "v_comment_events", "v_stories"))
def story_text_join(spark, sf):
    ev = E.comment_event_filter(E.comment_event_explode(
        E.signature_filter_hex(V.v_comment_events(spark, sf), TASKS_SECRET)))
    return E.story_text_join(ev, V.v_stories(spark, sf))


@register("route_comment", with_views(_X18, "v_comment_events", "v_stories"))
def route_comment(spark, sf):
    return routed_comments(spark, sf).select(
        "delivery_id", "event_no", "story_gid", "task_gid", "comment_text", "decision", "reason")


@register("missing_keyword_split", with_views(f"""
  SELECT article_id,
         CASE WHEN target_keyword IS NULL OR target_keyword = '' THEN 'failed' ELSE 'continue' END AS outcome,
         CASE WHEN target_keyword IS NULL OR target_keyword = '' THEN '{E.MISSING_KEYWORD_REASON}' END AS failure_reason
  FROM v_articles""", "v_articles"))
def missing_keyword_split(spark, sf):
    return E.missing_keyword_split(V.v_articles(spark, sf)).select("article_id", "outcome", "failure_reason")


@register("metafield_lookup", with_views("""
  SELECT a.article_id, nullif(m.value, '') AS target_keyword
  FROM v_articles a LEFT JOIN (
    SELECT article_id, arg_min(value, pos) AS value FROM v_metafields
    WHERE namespace = 'seo' AND key = 'target_keyword' GROUP BY article_id) m USING (article_id)""",
                                         "v_articles", "v_metafields"))
def metafield_lookup(spark, sf):
    a = V.v_articles(spark, sf).select("article_id")
    return E.metafield_lookup(a, V.v_metafields(spark, sf)).select("article_id", "target_keyword")


@register("article_scan", with_views("""
  SELECT article_id, blog_id, CASE WHEN CAST(article_id AS BIGINT) % 5 = 0 THEN '' ELSE coalesce(title, '') END AS title,
         CASE WHEN CAST(article_id AS BIGINT) % 7 = 0 THEN '' ELSE body_html END AS body_html
  FROM v_articles""", "v_articles"))
def article_scan(spark, sf):
    # stored records: numeric ids, some without a title or a body
    a, doc = V.v_articles(spark, sf), F.col("article_id").cast("bigint")
    records = a.select(doc.alias("id"), F.col("blog_id").cast("bigint").alias("blog_id"),
                       F.when(doc % 5 != 0, F.col("title")).alias("title"),
                       F.when(doc % 7 != 0, F.col("body_html")).alias("body_html"))
    return E.article_scan(records)
