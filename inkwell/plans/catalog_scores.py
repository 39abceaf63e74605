"""Score, similarity and language queries (A3, A5, J9, R2, R3, X3, X4, X19,
X22, D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import html as H
from inkwell.functions.language import BUCKETS, SCALE, detect_language, learn_profiles, route_language
from inkwell.functions.values import truncate_chars as tchars, truncate_words as twords
from inkwell.operators import scores as S
from inkwell.operators import similarity as SIM
from inkwell.plans import sqlfrag as Q
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import register
from inkwell.sources import views as V
from inkwell.sources.tables import read_table

_FLOAT = f"(CASE WHEN regexp_full_match({{x}}, '{Q.FLOAT_RE}') THEN CAST({{x}} AS DOUBLE) END)"


def _sql_float(col: str) -> str:
    s = Q.strip(col)
    return _FLOAT.format(x=s)


_SIM_VALUE = (f"coalesce({_sql_float('percentmatched')}, {_sql_float('minper')}, "
              f"{_sql_float('percent')}, 0.0)")
_DELTA = """
  SELECT article_id, initial, final, final - coalesce(initial, 0.0) AS score_delta,
         CASE WHEN coalesce(initial, 0.0) <> 0 THEN (final - coalesce(initial, 0.0)) / coalesce(initial, 0.0) * 100
              ELSE 0.0 END AS score_delta_pct
  FROM v_scores
"""


@register("score_delta", with_views(_DELTA, "v_scores"))
def score_delta(spark, sf):
    return S.score_delta(V.v_scores(spark, sf))


@register("low_delta_flag", with_views(
    f"SELECT article_id, score_delta, score_delta < {S.LOW_DELTA} AS manual_review FROM ({_DELTA})", "v_scores"))
def low_delta_flag(spark, sf):
    return S.low_delta_flag(S.score_delta(V.v_scores(spark, sf))).select("article_id", "score_delta", "manual_review")


@register("similarity_value", with_views(
    f"SELECT article_id, match_no, {_SIM_VALUE} AS similarity FROM v_matches", "v_matches"))
def similarity_value(spark, sf):
    m = V.v_matches(spark, sf)
    return m.select("article_id", "match_no", S.similarity_value(m).alias("similarity"))


@register("max_similarity_flag", with_views(f"""
  SELECT r.article_id, coalesce(m.mx, 0.0) AS max_similarity,
         coalesce(m.mx, 0.0) > {S.SIMILARITY_THRESHOLD} AS plagiarism_flagged
  FROM v_scores r LEFT JOIN (SELECT article_id, max({_SIM_VALUE}) AS mx FROM v_matches GROUP BY article_id) m
  USING (article_id)""", "v_scores", "v_matches"))
def max_similarity_flag(spark, sf):
    runs = V.v_scores(spark, sf).select("article_id")
    return S.max_similarity_flag(runs, V.v_matches(spark, sf))


@register("poll_first_done", with_views(f"""
  SELECT doc_id, CASE WHEN a IS NOT NULL THEN 'done' ELSE 'timeout' END AS outcome,
         a AS attempt, CASE WHEN a IS NOT NULL THEN coalesce(sc, 0.0) END AS content_score,
         coalesce(o.lsi_keywords, []) AS lsi_keywords, coalesce(o.suggested_headings, []) AS suggested_headings
  FROM (SELECT doc_id,
               min(attempt) FILTER (WHERE status = 'done' AND attempt <= {S.POLL_MAX_ATTEMPTS}) AS a,
               arg_min(content_score, attempt) FILTER (WHERE status = 'done' AND attempt <= {S.POLL_MAX_ATTEMPTS}) AS sc
        FROM v_polls GROUP BY doc_id)
  LEFT JOIN (SELECT doc_id, attempt AS a, lsi_keywords, suggested_headings FROM v_polls) o USING (doc_id, a)""", "v_polls"))
def poll_first_done(spark, sf):
    return S.poll_first_done(V.v_polls(spark, sf))


@register("document_id", with_views("""
  SELECT response_id, response, d AS doc_id,
         CASE WHEN d IS NULL THEN 'no document id in response' END AS error
  FROM (SELECT *, coalesce(nullif(json_extract_string(response, '$.id'), ''),
                           nullif(json_extract_string(response, '$.data.id'), '')) AS d
        FROM v_doc_responses)""", "v_doc_responses"))
def document_id(spark, sf):
    return S.document_id(V.v_doc_responses(spark, sf))


def _sql_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')"


def _sql_shingles(tok: str, k: int = SIM.SHINGLE_WORDS) -> str:
    """Shingles of a token-list *column* (a subquery computes it first)."""
    return (f"list_distinct(list_transform(range(1, len({tok}) - {k - 2}), "
            f"lambda i: array_to_string({tok}[i:i + {k - 1}], ' ')))")


_PAIRS = f"""
  SELECT a.article_id, c.source_id, CAST(count(*) AS INTEGER) AS shared,
         CAST(a.n AS INTEGER) AS article_shingles, count(*) * 100.0 / a.n AS similarity
  FROM (SELECT article_id, len(s) AS n, unnest(s) AS shingle
        FROM (SELECT article_id, {_sql_shingles('tok')} AS s
              FROM (SELECT article_id, {_sql_tokens(Q.html_to_text('body_html'))} AS tok FROM v_articles))) a
  JOIN (SELECT source_id, unnest(s) AS shingle
        FROM (SELECT source_id, {_sql_shingles('tok')} AS s
              FROM (SELECT source_id, {_sql_tokens('text')} AS tok FROM v_corpus))) c USING (shingle)
  GROUP BY a.article_id, c.source_id, a.n
"""


def _pairs(spark, sf):
    a = V.v_articles(spark, sf).select("article_id", H.html_to_text("body_html").alias("text"))
    return SIM.similarity_join(a, V.v_corpus(spark, sf))


@register("similarity_join", with_views(_PAIRS, "v_articles", "v_corpus"))
def similarity_join(spark, sf):
    return _pairs(spark, sf)


_BEST = f"""
  SELECT a.article_id, p.source_id, coalesce(p.shared, 0) AS shared, CAST(a.n AS INTEGER) AS article_shingles,
         coalesce(p.similarity, 0.0) AS similarity
  FROM (SELECT article_id, len({_sql_shingles('tok')}) AS n
        FROM (SELECT article_id, {_sql_tokens(Q.html_to_text('body_html'))} AS tok FROM v_articles)) a
  LEFT JOIN (SELECT * FROM ({_PAIRS})
             QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY shared DESC, source_id) = 1) p USING (article_id)"""


def _best(spark, sf):
    a = V.v_articles(spark, sf).select("article_id", H.html_to_text("body_html").alias("text"))
    return SIM.best_source(a, V.v_corpus(spark, sf))


@register("best_source", with_views(_BEST, "v_articles", "v_corpus"))
def best_source(spark, sf):
    return _best(spark, sf)


@register("similarity_flag", with_views(f"""
  SELECT a.article_id, coalesce(p.mx, 0.0) AS max_similarity, coalesce(p.mx, 0.0) > 15.0 AS plagiarism_flagged
  FROM v_articles a LEFT JOIN (SELECT article_id, max(similarity) AS mx FROM ({_PAIRS}) GROUP BY article_id) p
  USING (article_id)""", "v_articles", "v_corpus"))
def similarity_flag(spark, sf):
    return SIM.similarity_flag(_best(spark, sf))


_WORDS = f"list_filter(regexp_split_to_array({Q.html_to_text('body_html')}, '\\s+'), lambda w: w <> '')"


@register("truncate_words", with_views(f"""
  SELECT article_id, CASE WHEN len(w) <= 1000 THEN t ELSE array_to_string(w[1:1000], ' ') END AS text
  FROM (SELECT article_id, {Q.html_to_text('body_html')} AS t, {_WORDS} AS w FROM v_articles)""", "v_articles"))
def truncate_words(spark, sf):
    a = V.v_articles(spark, sf)
    return a.select("article_id", twords(H.html_to_text("body_html"), 1000).alias("text"))


@register("truncate_chars", with_views(
    f"SELECT article_id, substr({Q.html_to_text('body_html')}, 1, 2000) AS text FROM v_articles", "v_articles"))
def truncate_chars(spark, sf):
    a = V.v_articles(spark, sf)
    return a.select("article_id", tchars(H.html_to_text("body_html"), 2000).alias("text"))


def _sql_buckets(rows: str, key: str, text: str) -> str:
    """(key, b): a row per word, the bucket of its last three letters."""
    code = lambda k: f"(CASE WHEN length(e) >= {k} THEN unicode(e[{k}:{k}]) ELSE 0 END)"
    return f"""
  SELECT {key}, ({code(1)} * 961 + {code(2)} * 31 + {code(3)}) % {BUCKETS} AS b FROM (
    SELECT {key}, right(w, 3) AS e FROM (
      SELECT {key}, unnest(regexp_extract_all(lower({text}), '\\p{{L}}+')) AS w FROM {rows}))"""


_PROFILES = f"""
  SELECT l, b, CAST(round({SCALE} * ln((coalesce(c.n, 0) + 0.5) / (t.n + 0.5 * {BUCKETS}))) AS BIGINT) AS w
  FROM (SELECT l, sum(n) AS n FROM g GROUP BY l) t CROSS JOIN (SELECT unnest(range({BUCKETS})) AS b) b LEFT JOIN g c USING (l, b)"""


@register("detect_language", with_views(f"""
  SELECT * FROM (WITH g AS (
    SELECT l, b, count(*) AS n FROM ({_sql_buckets("(SELECT lang AS l, text FROM documents WHERE lang IS NOT NULL)", "l", "text")})
    GROUP BY l, b),
  p AS ({_PROFILES}),
  x AS (SELECT article_id, b, count(*) AS n FROM (
          {_sql_buckets(f"(SELECT article_id, {Q.html_to_text('body_html')} AS text FROM v_articles)", "article_id", "text")})
        GROUP BY article_id, b),
  s AS (SELECT article_id, l, sum(x.n * p.w) AS score FROM x JOIN p USING (b) GROUP BY article_id, l),
  d AS (SELECT article_id, arg_min(l, l) AS detected FROM (
          SELECT *, max(score) OVER (PARTITION BY article_id) AS best FROM s) WHERE score = best GROUP BY article_id)
  SELECT article_id, source_lang, coalesce(detected, 'fr') AS detected,
         CASE WHEN detected IN ('fr', 'en') THEN detected ELSE 'fr' END AS language
  FROM v_articles LEFT JOIN d USING (article_id))""", "v_articles"))
def detect_language_q(spark, sf):
    profiles = learn_profiles(read_table(spark, sf, "documents"))
    a = V.v_articles(spark, sf).withColumn("detected", detect_language(H.html_to_text("body_html"), profiles))
    return a.select("article_id", "source_lang", "detected", route_language(F.col("detected")).alias("language"))
