"""Competitor research queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import html as H
from inkwell.operators import competitors as C
from inkwell.plans import sqlfrag as Q
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import register
from inkwell.sources import views as V

_SKIPS = "[" + ", ".join(f"'{s}'" for s in C.SKIP_DOMAINS) + "]"

_RESULTS = """
  SELECT response_id, keyword, position, CAST(i - 1 AS INTEGER) AS entry,
         coalesce(json_extract_string(e, '$.link'), '') AS link
  FROM (SELECT response_id, keyword, position, unnest(o) AS e, generate_subscripts(o, 1) AS i
        FROM (SELECT *, CAST(json_extract(response, '$.organic') AS JSON[]) AS o FROM v_serp_responses))
"""

_HOST = "(CASE WHEN starts_with(link, 'http') THEN string_split(link, '/')[3] ELSE '' END)"
_KEEP = f"(link <> '' AND {_HOST} IS NOT NULL AND NOT list_bool_or(list_transform({_SKIPS}, lambda s: contains({_HOST}, s))))"

_TOP = f"""
  SELECT keyword, CAST(row_number() OVER (PARTITION BY keyword ORDER BY r) AS INTEGER) AS rank, link
  FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY position, entry) AS r FROM ({_RESULTS}))
  WHERE r <= {C.RESULTS_REQUESTED} AND {_KEEP}
  QUALIFY rank <= {C.COMPETITORS_KEPT}
"""

_FETCHED = f"""
  SELECT keyword, rank, link, web_id,
         {Q.tag_texts('c', 'h2')} AS h2s,
         {Q.word_count(Q.html_to_text('c'))} AS word_count
  FROM (SELECT t.keyword, t.rank, t.link, w.web_id, {Q.strip_boilerplate('w.html')} AS c
        FROM ({_TOP}) t JOIN v_web w ON w.url = t.link
        QUALIFY row_number() OVER (PARTITION BY t.keyword, t.rank ORDER BY w.web_id) = 1)
"""

TEXTS = f"""
  SELECT keyword, web_id, text, {Q.word_count('text')} AS word_count FROM (
    SELECT keyword, web_id, {Q.html_to_text('c')} AS text
    FROM (SELECT t.keyword, w.web_id, {Q.strip_boilerplate('w.html')} AS c
          FROM ({_TOP}) t JOIN v_web w ON w.url = t.link
          QUALIFY row_number() OVER (PARTITION BY t.keyword, t.rank ORDER BY w.web_id) = 1))
"""

_UNION = f"""
  SELECT keyword, rank AS page_rank, CAST(generate_subscripts(h2s, 1) AS INTEGER) AS h2_pos, unnest(h2s) AS h2
  FROM ({_FETCHED})
"""

_TOPICS = f"""
  SELECT keyword, CAST(row_number() OVER (PARTITION BY keyword ORDER BY page_rank, h2_pos) AS INTEGER) AS topic_rank, h2
  FROM ({_UNION})
  QUALIFY row_number() OVER (PARTITION BY keyword, lower(h2) ORDER BY page_rank, h2_pos) = 1
"""


def _topics_sql() -> str:
    # rank after first-spelling de-duplication
    return f"""
  SELECT keyword, CAST(row_number() OVER (PARTITION BY keyword ORDER BY page_rank, h2_pos) AS INTEGER) AS topic_rank, h2
  FROM ({_UNION})
  QUALIFY row_number() OVER (PARTITION BY keyword, lower(h2) ORDER BY page_rank, h2_pos) = 1"""


_TOPICS_KEPT = f"""
  SELECT keyword, CAST(row_number() OVER (PARTITION BY keyword ORDER BY page_rank, h2_pos) AS INTEGER) AS topic_rank, h2
  FROM (SELECT * FROM ({_UNION})
        QUALIFY row_number() OVER (PARTITION BY keyword, lower(h2) ORDER BY page_rank, h2_pos) = 1)
  QUALIFY topic_rank <= {C.H2_TOPICS_KEPT}
"""

_AVGS = f"""
  SELECT keyword, CAST(trunc(sum(word_count) / greatest(count(*), 1)) AS INTEGER) AS avg_word_count,
         CAST(trunc(sum(len(h2s)) / greatest(count(*), 1)) AS INTEGER) AS avg_h2_count,
         CAST(count(*) AS INTEGER) AS pages_used
  FROM ({_FETCHED}) GROUP BY keyword
"""


def _responses(spark, sf):
    return C.search_results_scan(V.v_serp_responses(spark, sf))


def _top(spark, sf):
    return C.competitor_top(_responses(spark, sf))


def _fetched(spark, sf):
    return C.fetch_competitors(_top(spark, sf), V.v_web(spark, sf))


@register("search_results_scan", with_views(_RESULTS, "v_serp_responses"))
def search_results_scan(spark, sf):
    return _responses(spark, sf)


@register("domain_skip_filter", with_views(f"SELECT * FROM ({_RESULTS}) WHERE {_KEEP}", "v_serp_responses"))
def domain_skip_filter(spark, sf):
    return C.domain_skip_filter(_responses(spark, sf))


@register("competitor_top3", with_views(_TOP, "v_serp_responses"))
def competitor_top3(spark, sf):
    return _top(spark, sf)


@register("strip_boilerplate", with_views(
    f"SELECT page_id, {Q.strip_boilerplate('html')} AS html_clean FROM pages"))
def strip_boilerplate(spark, sf):
    return V.v_pages(spark, sf).select("page_id", H.strip_boilerplate("html").alias("html_clean"))


@register("html_to_text", with_views(f"SELECT page_id, {Q.html_to_text('html')} AS text FROM pages"))
def html_to_text(spark, sf):
    return V.v_pages(spark, sf).select("page_id", H.html_to_text("html").alias("text"))


@register("word_count", with_views(
    f"SELECT page_id, {Q.word_count(Q.html_to_text(Q.strip_boilerplate('html')))} AS word_count FROM pages"))
def word_count(spark, sf):
    return V.v_pages(spark, sf).select(
        "page_id", H.word_count(H.html_to_text(H.strip_boilerplate("html"))).alias("word_count"))


@register("heading_text", with_views(
    "SELECT article_id, seq, level, heading_text FROM v_headings", "v_headings"))
def heading_text(spark, sf):
    a = V.v_articles(spark, sf)
    z = F.arrays_zip(H.heading_levels("body_html").alias("level"),
                     H.heading_texts("body_html").alias("heading_text"))
    return a.select("article_id", F.posexplode(z).alias("_i", "_h")).select(
        "article_id", (F.col("_i") + 1).cast("int").alias("seq"),
        F.col("_h.level").alias("level"), F.col("_h.heading_text").alias("heading_text"))


@register("page_heading_counts", with_views(f"""
  SELECT page_id, url, coalesce(({Q.tag_texts('c', 'h1')})[1], '') AS h1,
         CAST(len({Q.tag_texts('c', 'h2')}) AS INTEGER) AS h2_count,
         CAST(len({Q.tag_texts('c', 'h3')}) AS INTEGER) AS h3_count,
         {Q.word_count(Q.html_to_text('c'))} AS word_count
  FROM (SELECT page_id, url, {Q.strip_boilerplate('html')} AS c FROM pages)"""))
def page_heading_counts(spark, sf):
    return C.page_heading_counts(V.v_pages(spark, sf))


@register("heading_union", with_views(_UNION, "v_serp_responses", "v_web"))
def heading_union(spark, sf):
    return C.heading_union(_fetched(spark, sf))


@register("h2_topics", with_views(_TOPICS_KEPT, "v_serp_responses", "v_web"))
def h2_topics(spark, sf):
    return C.h2_topics(C.heading_union(_fetched(spark, sf)))


@register("avg_word_count", with_views(_AVGS, "v_serp_responses", "v_web"))
def avg_word_count(spark, sf):
    return C.structure_averages(_fetched(spark, sf))


_FALLBACK_TOPICS = "[" + ", ".join(
    "'" + t.split('{kw}')[0] + "' || keyword || '" + t.split('{kw}')[1] + "'"
    for t in C.FALLBACK_TOPIC_TEMPLATES) + "]"


@register("competitor_fallback", with_views(f"""
  SELECT k.keyword,
         array_to_string(CASE WHEN p.links IS NOT NULL THEN p.links WHEN u.links IS NOT NULL THEN u.links
                              ELSE [] END, ' ') AS competitor_urls,
         array_to_string(CASE WHEN p.links IS NOT NULL THEN coalesce(t.topics, [])
                              ELSE {_FALLBACK_TOPICS} END, ' | ') AS h2_topics,
         CASE WHEN p.links IS NOT NULL THEN a.avg_word_count ELSE {C.FALLBACK_WORD_COUNT} END AS avg_word_count,
         CASE WHEN p.links IS NOT NULL THEN a.avg_h2_count ELSE {C.FALLBACK_H2_COUNT} END AS avg_h2_count,
         CASE WHEN p.links IS NOT NULL THEN 'competitors' ELSE 'template' END AS structure_source
  FROM (SELECT DISTINCT target_keyword AS keyword FROM v_articles) k
  LEFT JOIN (SELECT keyword, list(link ORDER BY rank) AS links FROM ({_TOP}) GROUP BY keyword) u USING (keyword)
  LEFT JOIN (SELECT keyword, list(link ORDER BY rank) AS links FROM ({_FETCHED}) GROUP BY keyword) p USING (keyword)
  LEFT JOIN (SELECT keyword, list(h2 ORDER BY topic_rank) AS topics FROM ({_TOPICS_KEPT}) GROUP BY keyword) t USING (keyword)
  LEFT JOIN ({_AVGS}) a USING (keyword)
  WHERE k.keyword IS NOT NULL""", "v_serp_responses", "v_web", "v_articles"))
def competitor_fallback(spark, sf):
    kws = V.v_articles(spark, sf).select(F.col("target_keyword").alias("keyword")).where(
        F.col("keyword").isNotNull())
    top = C.competitor_links(_responses(spark, sf))
    s = C.competitor_structure(kws, top, C.fetch_competitors(top, V.v_web(spark, sf)))
    return s.select(
        "keyword",
        F.array_join("competitor_urls", " ").alias("competitor_urls"),
        F.array_join("h2_topics", " | ").alias("h2_topics"),
        "avg_word_count", "avg_h2_count", "structure_source")
