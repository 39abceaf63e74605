"""Keyword research queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import keywords as K
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import register
from inkwell.plans.sqlfrag import lines, parse_float, parse_int, strip
from inkwell.sources import views as V

_OVERVIEW = f"""
  SELECT report_id, seed,
         CASE WHEN ok THEN {strip('f[1]')} ELSE seed END AS keyword,
         CASE WHEN ok THEN {parse_int('f[2]')} ELSE CAST(0 AS BIGINT) END AS volume,
         CASE WHEN ok THEN {parse_float('f[3]')} ELSE 0.0 END AS difficulty,
         CASE WHEN ok THEN {parse_float('f[4]')} ELSE 0.0 END AS cpc
  FROM (SELECT *, coalesce(len(ls) >= 2 AND len(f) >= 4, false) AS ok
        FROM (SELECT *, string_split(ls[2], ';') AS f
              FROM (SELECT *, {lines('report')} AS ls FROM v_overview_reports)))
"""

_DATA_LINES = f"""
  SELECT seed, CAST(page * {V.REPORT_PAGE_ROWS} + i AS INTEGER) AS pos, line
  FROM (SELECT seed, page, unnest(dl) AS line, generate_subscripts(dl, 1) AS i
        FROM (SELECT seed, page, ({lines('report')})[2:] AS dl FROM v_keyword_reports))
"""

_RELATED = f"""
  SELECT seed, pos, {strip('f[1]')} AS keyword, {parse_int('f[2]')} AS volume,
         {parse_float('f[3]')} AS difficulty
  FROM (SELECT *, string_split(line, ';') AS f FROM ({_DATA_LINES}))
  WHERE len(f) >= 3
"""

_QUESTIONS = f"SELECT seed, pos, {strip('line')} AS question FROM ({_DATA_LINES})"


@register("keyword_overview_parse", with_views(_OVERVIEW, "v_overview_reports"))
def keyword_overview_parse(spark, sf):
    return K.keyword_overview_parse(V.v_overview_reports(spark, sf))


@register("main_keyword", with_views(f"""
  SELECT report_id, seed, coalesce(nullif(keyword, ''), seed) AS main_keyword,
         volume AS main_kw_volume, difficulty AS main_kw_difficulty FROM ({_OVERVIEW})""",
                                     "v_overview_reports"))
def main_keyword(spark, sf):
    return K.main_keyword(K.keyword_overview_parse(V.v_overview_reports(spark, sf)))


@register("parse_value", with_views(f"""
  SELECT report_id, f[2] AS raw_volume, {parse_int('f[2]')} AS volume,
         f[4] AS raw_cpc, {parse_float('f[4]')} AS cpc
  FROM (SELECT report_id, string_split(({lines('report')})[2], ';') AS f FROM v_overview_reports)
  WHERE f IS NOT NULL""", "v_overview_reports"))
def parse_value(spark, sf):
    from inkwell.functions.values import lines_of, parse_float as pf, parse_int as pi
    r = V.v_overview_reports(spark, sf)
    f = F.split(F.try_element_at(lines_of("report"), F.lit(2)), ";", -1)
    return (r.withColumn("_f", f).where(F.col("_f").isNotNull()).select(
        "report_id",
        F.try_element_at("_f", F.lit(2)).alias("raw_volume"),
        pi(F.try_element_at("_f", F.lit(2))).alias("volume"),
        F.try_element_at("_f", F.lit(4)).alias("raw_cpc"),
        pf(F.try_element_at("_f", F.lit(4))).alias("cpc")))


@register("related_keywords_parse", with_views(_RELATED, "v_keyword_reports"))
def related_keywords_parse(spark, sf):
    return K.related_keywords_parse(V.v_keyword_reports(spark, sf))


@register("question_keywords_parse", with_views(_QUESTIONS, "v_keyword_reports"))
def question_keywords_parse(spark, sf):
    return K.question_keywords_parse(V.v_keyword_reports(spark, sf))


@register("keyword_ratio", with_views("""
  SELECT seed, pos, keyword, CAST(volume AS DOUBLE) / greatest(difficulty, 1.0) AS ratio
  FROM v_keywords""", "v_keywords"))
def keyword_ratio(spark, sf):
    k = V.v_keywords(spark, sf)
    return k.select("seed", "pos", "keyword", K.keyword_ratio().alias("ratio"))


@register("secondary_keywords", with_views(f"""
  SELECT seed, CAST(rank AS INTEGER) AS rank, keyword, ratio FROM (
    SELECT seed, keyword, ratio,
           row_number() OVER (PARTITION BY seed ORDER BY ratio DESC, pos ASC) AS rank
    FROM (SELECT *, CAST(volume AS DOUBLE) / greatest(difficulty, 1.0) AS ratio FROM ({_RELATED})))
  WHERE rank <= {K.SECONDARY_LIMIT}""", "v_keyword_reports"))
def secondary_keywords(spark, sf):
    return K.secondary_keywords(K.related_keywords_parse(V.v_keyword_reports(spark, sf)))


@register("question_top3", with_views(f"""
  SELECT seed, CAST(rank AS INTEGER) AS rank, question FROM (
    SELECT seed, question, row_number() OVER (PARTITION BY seed ORDER BY pos) AS rank
    FROM ({_QUESTIONS}))
  WHERE rank <= {K.QUESTION_LIMIT}""", "v_keyword_reports"))
def question_top3(spark, sf):
    return K.question_top(K.question_keywords_parse(V.v_keyword_reports(spark, sf)))


@register("language_database_lookup", with_views("""
  SELECT article_id, source_lang AS language,
         CASE WHEN source_lang = 'fr' THEN 'ca' ELSE 'us' END AS database
  FROM v_articles""", "v_articles"))
def language_database_lookup(spark, sf):
    a = V.v_articles(spark, sf)
    return a.select("article_id", F.col("source_lang").alias("language"),
                    K.database_for_language("source_lang").alias("database"))


@register("search_locale", with_views(f"""
  SELECT article_id, target_keyword AS keyword, source_lang AS language,
         CASE WHEN source_lang = 'fr' THEN 'ca' ELSE 'us' END AS gl,
         source_lang AS hl, {K.SEARCH_RESULTS + K.SEARCH_OVERFETCH} AS num
  FROM v_articles""", "v_articles"))
def search_locale(spark, sf):
    a = V.v_articles(spark, sf).select(
        "article_id", F.col("target_keyword").alias("keyword"), F.col("source_lang").alias("language"))
    return K.search_locale(a)


# --- the same for the articles' own keywords ---------------------------------------
def _topic(sql: str) -> str:
    return sql.replace("v_keyword_reports", "v_topic_reports")


TOPIC_KEYWORDS = _topic(f"""
  SELECT seed, CAST(rank AS INTEGER) AS rank, keyword, ratio FROM (
    SELECT seed, keyword, ratio, row_number() OVER (PARTITION BY seed ORDER BY ratio DESC, pos ASC) AS rank
    FROM (SELECT *, CAST(volume AS DOUBLE) / greatest(difficulty, 1.0) AS ratio FROM ({_RELATED})))
  WHERE rank <= {K.SECONDARY_LIMIT}""")
TOPIC_QUESTIONS = f"""
  SELECT seed, CAST(rank AS INTEGER) AS rank, question FROM (
    SELECT seed, question, row_number() OVER (PARTITION BY seed ORDER BY pos) AS rank
    FROM ({_QUESTIONS.replace("v_keyword_reports", "v_question_reports")}))
  WHERE rank <= {K.QUESTION_LIMIT}"""


@register("topic_keywords", with_views(TOPIC_KEYWORDS, "v_topic_reports"))
def topic_keywords(spark, sf):
    return K.secondary_keywords(K.related_keywords_parse(V.v_topic_reports(spark, sf)))


@register("topic_questions", with_views(TOPIC_QUESTIONS, "v_question_reports"))
def topic_questions(spark, sf):
    return K.question_top(K.question_keywords_parse(V.v_question_reports(spark, sf)))
