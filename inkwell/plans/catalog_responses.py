"""Generated-output queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import competitors as C
from inkwell.operators import keywords as K
from inkwell.operators import reports as R
from inkwell.operators import responses as RS
from inkwell.operators import scores as S
from inkwell.plans import catalog_competitors as CC
from inkwell.plans import catalog_keywords, catalog_scores  # noqa: F401  (their oracles are composed)
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import ORACLES, register
from inkwell.sources import views as V
from inkwell.sources.published import published

_STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


_EXTRACT = f"""
  SELECT article_id, raw,
         CASE WHEN starts_with(s, '```') THEN {_strip("array_to_string(CASE WHEN " + _strip('ls[len(ls)]') + " = '```' THEN ls[2:len(ls) - 1] ELSE ls[2:] END, chr(10))")}
              ELSE s END AS extracted
  FROM (SELECT *, string_split(s, chr(10)) AS ls FROM (SELECT *, {_strip('raw')} AS s FROM v_responses))
"""

_FIELDS = ("optimized_html", "title_tag", "meta_description", "slug", "og_title", "og_description", "changes_summary")
_PARSED = f"""
  SELECT article_id, extracted, json_valid(extracted) AS valid,
         {", ".join(f"CASE WHEN json_valid(extracted) THEN coalesce(json_extract_string(extracted, '$.{f}'), '') ELSE '' END AS {f}" for f in _FIELDS)},
         CASE WHEN json_valid(extracted) THEN CAST(json_extract(extracted, '$.schema_markup') AS VARCHAR) END AS schema_markup,
         CASE WHEN json_valid(extracted) THEN CAST(json_extract(extracted, '$.internal_link_suggestions') AS JSON[]) ELSE [] END AS links,
         CASE WHEN json_valid(extracted) THEN coalesce(len(json_keys(json_extract(extracted, '$.alt_texts'))), 0) ELSE 0 END AS n_alt_texts
  FROM ({_EXTRACT})
"""


def _parsed(spark, sf):
    return RS.parse_responses(V.v_responses(spark, sf))


@register("extract_json", with_views(f"SELECT article_id, extracted FROM ({_EXTRACT})", "v_responses"))
def extract_json(spark, sf):
    r = V.v_responses(spark, sf)
    return r.select("article_id", RS.extract_json_text(F.col("raw")).alias("extracted"))


@register("json_validity", with_views(f"""
  SELECT article_id, valid, CASE WHEN valid THEN NULL ELSE '{RS.INVALID_REASON}' END AS failure_reason
  FROM ({_PARSED})""", "v_responses"))
def json_validity(spark, sf):
    p = _parsed(spark, sf)
    return p.select("article_id", "valid",
                    F.when(~F.col("valid"), F.lit(RS.INVALID_REASON)).alias("failure_reason"))


@register("output_fields", with_views(f"""
  SELECT article_id, {", ".join(_FIELDS)}, schema_markup,
         CAST(len(links) AS INTEGER) AS n_links, CAST(n_alt_texts AS INTEGER) AS n_alt_texts
  FROM ({_PARSED})""", "v_responses"))
def output_fields(spark, sf):
    p = _parsed(spark, sf)
    return p.select("article_id", *_FIELDS, "schema_markup",
                    F.size("internal_link_suggestions").cast("int").alias("n_links"),
                    F.size("alt_texts").cast("int").alias("n_alt_texts"))


@register("format_internal_links", with_views(f"""
  SELECT article_id,
         CASE WHEN len(links) = 0 THEN '{R.NO_LINKS}'
              ELSE array_to_string(list_transform(links, lambda s: printf('{R.LINK_LINE.replace("'", "''")}',
                     coalesce(json_extract_string(s, '$.location'), ''),
                     coalesce(json_extract_string(s, '$.suggested_topic'), ''))), chr(10)) END AS links_text
  FROM ({_PARSED})""", "v_responses"))
def format_internal_links(spark, sf):
    p = _parsed(spark, sf)
    return p.select("article_id", R.format_internal_links("internal_link_suggestions").alias("links_text"))


@register("article_writeback", with_views(f"""
  SELECT article_id, optimized_html AS body_html, title_tag AS title, slug AS handle
  FROM ({_PARSED}) WHERE valid""", "v_responses"))
def article_writeback(spark, sf):
    return published(RS.article_writeback(_parsed(spark, sf)), "writeback")


@register("metafield_rows", with_views(f"""
  SELECT * FROM (
    SELECT article_id, 'seo' AS namespace, 'meta_description' AS key, meta_description AS value,
           'single_line_text_field' AS type FROM ({_PARSED}) WHERE valid
    UNION ALL SELECT article_id, 'seo', 'og_title', og_title, 'single_line_text_field' FROM ({_PARSED}) WHERE valid
    UNION ALL SELECT article_id, 'seo', 'og_description', og_description, 'single_line_text_field' FROM ({_PARSED}) WHERE valid
    UNION ALL SELECT article_id, 'seo', 'schema_markup', schema_markup, 'json' FROM ({_PARSED}) WHERE valid)
  WHERE value IS NOT NULL AND value <> ''""", "v_responses"))
def metafield_rows(spark, sf):
    return published(RS.metafield_rows(_parsed(spark, sf)), "metafields")


@register("correction_batch", with_views(f"""
  SELECT article_id, CAST(t.turn AS INTEGER) AS turn, t.role, t.content FROM (
    SELECT article_id, unnest([
      {{'turn': 0, 'role': 'user', 'content': '{{"article_id":"' || article_id || '"}}'}},
      {{'turn': 1, 'role': 'assistant', 'content': raw}},
      {{'turn': 2, 'role': 'user', 'content': printf('{RS.CORRECTION_PROMPT.replace(chr(10), "' || chr(10) || '")}', substr(raw, 1, {RS.CORRECTION_CHARS}))}}
    ]) AS t
    FROM ({_EXTRACT}) WHERE NOT json_valid(extracted))""", "v_responses"))
def correction_batch(spark, sf):
    p = _parsed(spark, sf).where(~F.col("valid")).withColumn(
        "context", F.to_json(F.struct("article_id")))
    return RS.correction_batch(p)


@register("prompt_template_join", with_views("""
  SELECT a.article_id, a.language, replace(p.system_prompt, '{brand_voice_content}', coalesce(p.brand_voice, ''))
         AS system_prompt
  FROM (SELECT article_id, CASE WHEN source_lang = 'fr' THEN 'fr' ELSE 'en' END AS language FROM v_articles) a
  LEFT JOIN v_prompts p ON p.language = a.language""", "v_articles", "v_prompts"))
def prompt_template_join(spark, sf):
    a = V.v_articles(spark, sf).select(
        "article_id", F.when(F.col("source_lang") == "fr", "fr").otherwise("en").alias("language"))
    return RS.prompt_template_join(a, V.v_prompts(spark, sf)).select("article_id", "language", "system_prompt")


_SEED = "'Brand#' || CAST(CAST(article_id AS BIGINT) % 25 + 1 AS VARCHAR)"
_STRUCTURE = f"""
  SELECT p.keyword, {{'h2_topics': coalesce(t.topics, []), 'avg_word_count': a.avg_word_count,
                     'avg_h2_count': a.avg_h2_count}} AS s
  FROM (SELECT DISTINCT keyword FROM ({CC._FETCHED})) p
  LEFT JOIN (SELECT keyword, list(h2 ORDER BY topic_rank) AS topics FROM ({CC._TOPICS_KEPT}) GROUP BY keyword) t USING (keyword)
  LEFT JOIN ({CC._AVGS}) a USING (keyword)"""


def _lists_sql(query: str, column: str) -> str:
    return f"(SELECT seed, list({column} ORDER BY rank) AS l FROM ({ORACLES[query]}) GROUP BY seed)"


def _context_oracle() -> str:
    return with_views(f"""
  SELECT a.article_id, CAST(json_object(
           'title', a.title, 'body_html', a.body_html,
           'language', CASE WHEN a.source_lang = 'fr' THEN 'fr' ELSE 'en' END, 'main_keyword', a.target_keyword,
           'secondary_keywords', coalesce(k.l, []), 'question_keywords', coalesce(q.l, []),
           'lsi_keywords', coalesce(o.lsi_keywords, []), 'suggested_headings', coalesce(o.suggested_headings, []),
           'competitor_heading_structure', coalesce(c.s, {{'h2_topics': {CC._FALLBACK_TOPICS.replace('keyword', 'a.target_keyword')},
             'avg_word_count': {C.FALLBACK_WORD_COUNT}, 'avg_h2_count': {C.FALLBACK_H2_COUNT}}})) AS VARCHAR) AS context
  FROM (SELECT *, {_SEED} AS seed FROM v_articles WHERE target_keyword <> '') a
  LEFT JOIN {_lists_sql('secondary_keywords', 'keyword')} k ON k.seed = a.seed
  LEFT JOIN {_lists_sql('question_top3', 'question')} q ON q.seed = a.seed
  LEFT JOIN ({ORACLES['poll_first_done']}) o ON o.doc_id = a.article_id
  LEFT JOIN ({_STRUCTURE}) c ON c.keyword = a.target_keyword""", "v_articles", "v_serp_responses", "v_web")


def _by_seed(rows, column: str):
    """At most five values per seed, in rank order."""
    return rows.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("rank", column))).alias("_l")).select(
        "seed", F.col(f"_l.{column}").alias(column + "s"))


@register("prompt_context", _context_oracle())
def prompt_context(spark, sf):
    """The context document of every article with a keyword."""
    reports = V.v_keyword_reports(spark, sf)
    secondary = _by_seed(K.secondary_keywords(K.related_keywords_parse(reports)), "keyword")
    questions = _by_seed(K.question_top(K.question_keywords_parse(reports)), "question")
    scored = S.poll_first_done(V.v_polls(spark, sf)).select("doc_id", "lsi_keywords", "suggested_headings")
    a = V.v_articles(spark, sf).where("target_keyword <> ''")
    top = C.competitor_links(C.search_results_scan(V.v_serp_responses(spark, sf)))
    structure = C.competitor_structure(a.select(F.col("target_keyword").alias("keyword")), top,
                                       C.fetch_competitors(top, V.v_web(spark, sf)))
    structure = structure.select("keyword", F.struct("h2_topics", "avg_word_count", "avg_h2_count")
                                 .alias("competitor_heading_structure"))
    none = F.array().cast("array<string>")
    a = a.select(
        "article_id", "title", "body_html", F.when(F.col("source_lang") == "fr", "fr").otherwise("en").alias("language"),
        F.col("target_keyword").alias("main_keyword"),
        F.concat(F.lit("Brand#"), (F.col("article_id").cast("bigint") % 25 + 1).cast("string")).alias("seed"))
    # the lists are joined to the keys alone, so that the texts are shuffled once
    k = a.select("article_id", "main_keyword", "seed").distinct()
    k = (k.join(secondary, "seed", "left").join(questions, "seed", "left")
         .join(scored, k["article_id"] == scored["doc_id"], "left")
         .join(structure, k["main_keyword"] == structure["keyword"], "left")
         .select(F.col("article_id").alias("_id"), F.col("main_keyword").alias("_keyword"),
                 F.coalesce("keywords", none).alias("secondary_keywords"),
                 F.coalesce("questions", none).alias("question_keywords"),
                 F.coalesce("lsi_keywords", none).alias("lsi_keywords"),
                 F.coalesce("suggested_headings", none).alias("suggested_headings"), "competitor_heading_structure"))
    full = a.join(k, a["article_id"].eqNullSafe(k["_id"]) & (a["main_keyword"] == k["_keyword"])).drop("_id", "_keyword")
    return full.select("article_id", RS.prompt_context(full).alias("context"))
