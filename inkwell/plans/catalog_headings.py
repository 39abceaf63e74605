"""Heading repair queries (W1-W4, W8, X9).  Spark works on per-article
arrays; the oracles work on the relational heading twin with windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import headings as HD
from inkwell.plans.oracle_views import NL, sql_escape, with_views
from inkwell.plans.registry import register
from inkwell.sources import views as V

_WORDS = "[" + ", ".join(f"'{w}'" for w in HD.CONCLUSION_WORDS) + "]"

FIX = """
  SELECT article_id, seq, heading_text,
         CAST(CASE WHEN level = 1 AND seq > first_h1 THEN 2 ELSE level END AS INTEGER) AS fixed_level
  FROM (SELECT *, min(CASE WHEN level = 1 THEN seq END) OVER (PARTITION BY article_id) AS first_h1
        FROM v_headings)
  UNION ALL
  SELECT article_id, 0 AS seq, coalesce(title, '') AS heading_text, 1 AS fixed_level
  FROM v_articles a
  WHERE regexp_replace(body_html, '\\s+', '', 'g') <> ''
    AND NOT EXISTS (SELECT 1 FROM v_headings h WHERE h.article_id = a.article_id AND h.level = 1)
"""

NORM = f"""
  SELECT *, CAST(least(i + 1, i + min(fixed_level - i) OVER (PARTITION BY article_id ORDER BY seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS INTEGER) AS level
  FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY seq) AS i FROM ({FIX}))
"""

_IS_CONCL = f"list_bool_or(list_transform({_WORDS}, lambda w: contains(lower(heading_text), w)))"

MARKS = f"""
  SELECT m.article_id, m.intro_start, m.intro_end, m.conclusion_seq, n.next_seq AS conclusion_end
  FROM (SELECT article_id,
               CASE WHEN min(seq) FILTER (WHERE level = 2) IS NOT NULL THEN min(seq) FILTER (WHERE level = 1) END AS intro_start,
               CASE WHEN min(seq) FILTER (WHERE level = 1) IS NOT NULL THEN min(seq) FILTER (WHERE level = 2) END AS intro_end,
               max(seq) FILTER (WHERE level = 2 AND {_IS_CONCL}) AS conclusion_seq
        FROM ({NORM}) GROUP BY article_id) m
  LEFT JOIN (SELECT article_id, seq, lead(seq) OVER (PARTITION BY article_id ORDER BY seq) AS next_seq
             FROM ({NORM})) n ON n.article_id = m.article_id AND n.seq = m.conclusion_seq
"""


def _plan(spark, sf):
    return HD.with_heading_plan(V.v_articles(spark, sf))


@register("h1_fix", with_views(f"SELECT article_id, seq, fixed_level AS level, heading_text FROM ({FIX})",
                               "v_headings", "v_articles"))
def h1_fix(spark, sf):
    return HD.heading_rows(_plan(spark, sf)).select(
        "article_id", "seq", F.col("fixed_level").alias("level"), "heading_text")


@register("heading_levels", with_views(f"SELECT article_id, seq, fixed_level, level FROM ({NORM})",
                                       "v_headings", "v_articles"))
def heading_levels(spark, sf):
    return HD.heading_rows(_plan(spark, sf)).select("article_id", "seq", "fixed_level", "level")


@register("intro_bounds", with_views(
    f"SELECT article_id, intro_start, intro_end FROM ({MARKS}) WHERE intro_start IS NOT NULL",
    "v_headings", "v_articles"))
def intro_bounds(spark, sf):
    p = _plan(spark, sf).where(F.col("intro_start") > 0)
    return p.select("article_id", HD.position_to_seq(F.col("intro_start")).alias("intro_start"),
                    HD.position_to_seq(F.col("intro_end")).alias("intro_end"))


@register("conclusion_bounds", with_views(
    f"SELECT article_id, conclusion_seq, conclusion_end FROM ({MARKS}) WHERE conclusion_seq IS NOT NULL",
    "v_headings", "v_articles"))
def conclusion_bounds(spark, sf):
    p = _plan(spark, sf).where(F.col("conclusion_at") > 0)
    return p.select(
        "article_id", HD.position_to_seq(F.col("conclusion_at")).alias("conclusion_seq"),
        F.when(F.col("conclusion_end") <= F.size("levels"), HD.position_to_seq(F.col("conclusion_end")))
        .alias("conclusion_end"))


def _oracle_skips() -> str:
    return f"""
  SELECT a.article_id, CAST(coalesce(s.headings, 0) AS INTEGER) AS headings,
         CAST(coalesce(s.skips, 0) AS INTEGER) AS skips, CAST(coalesce(s.corrected, 0) AS INTEGER) AS corrected
  FROM v_articles a LEFT JOIN (
    SELECT article_id, count(*) AS headings, sum(CASE WHEN fixed_level > prev + 1 THEN 1 ELSE 0 END) AS skips,
           sum(CASE WHEN fixed_level <> level THEN 1 ELSE 0 END) AS corrected
    FROM (SELECT *, coalesce(lag(fixed_level) OVER (PARTITION BY article_id ORDER BY seq), 1) AS prev FROM ({NORM}))
    GROUP BY article_id) s USING (article_id)"""


@register("heading_skips", with_views(f"""
  SELECT a.article_id, CAST(coalesce(s.headings, 0) AS INTEGER) AS headings,
         CAST(coalesce(s.skips, 0) AS INTEGER) AS skips, CAST(coalesce(s.corrected, 0) AS INTEGER) AS corrected
  FROM v_articles a LEFT JOIN (
    SELECT article_id, count(*) AS headings, sum(CASE WHEN fixed_level > prev + 1 THEN 1 ELSE 0 END) AS skips,
           sum(CASE WHEN fixed_level <> level THEN 1 ELSE 0 END) AS corrected
    FROM (SELECT *, coalesce(lag(fixed_level) OVER (PARTITION BY article_id ORDER BY seq), 1) AS prev FROM ({NORM}))
    GROUP BY article_id) s USING (article_id)""", "v_headings", "v_articles"))
def heading_skips(spark, sf):
    return HD.heading_skips(_plan(spark, sf))


def _marker_sql(seq: str) -> str:
    return (f"(CASE WHEN {seq} = mk.intro_start THEN '{HD.INTRO_START}' ELSE '' END || "
            f"CASE WHEN {seq} = mk.intro_end THEN '{HD.INTRO_END}' ELSE '' END || "
            f"CASE WHEN {seq} = mk.conclusion_seq THEN '{HD.CONCLUSION_START}' ELSE '' END || "
            f"CASE WHEN {seq} = mk.conclusion_end THEN '{HD.CONCLUSION_END}' ELSE '' END)")


_REWRITE = f"""
  WITH lines AS (
    SELECT CAST(doc_id AS VARCHAR) AS article_id, doc_id, lang, last_h, i, x,
           CASE WHEN i % 3 = 0 AND x <> '' THEN
                row_number() OVER (PARTITION BY doc_id, (i % 3 = 0 AND x <> '') ORDER BY i) END AS hseq
    FROM (SELECT doc_id, lang, last_h, unnest(lines) AS x, generate_subscripts(lines, 1) - 1 AS i
          FROM v_doc_lines)
    WHERE x <> ''),
  mk AS ({MARKS}),
  pieces AS (
    SELECT l.article_id, l.i,
           CASE WHEN l.hseq IS NULL THEN '<p>' || {sql_escape('l.x')} || '</p>'
                ELSE {_marker_sql('l.hseq')} || '<h' || CAST(n.level AS VARCHAR) || '>' ||
                     CASE WHEN l.doc_id % 5 = 0 AND l.i = l.last_h
                          THEN (CASE WHEN l.lang = 'fr' THEN 'Résumé' ELSE 'Conclusion' END)
                          ELSE {sql_escape('l.x')} END ||
                     '</h' || CAST(n.level AS VARCHAR) || '>' END AS piece
    FROM lines l
    LEFT JOIN mk ON mk.article_id = l.article_id
    LEFT JOIN ({NORM}) n ON n.article_id = l.article_id AND n.seq = l.hseq),
  joined AS (SELECT article_id, string_agg(piece, {NL} ORDER BY i) AS body FROM pieces GROUP BY article_id)
  SELECT a.article_id,
         CASE WHEN regexp_replace(a.body_html, '\\s+', '', 'g') = '' THEN a.body_html
              ELSE (CASE WHEN ins.article_id IS NOT NULL
                         THEN {_marker_sql('0')} || '<h1>' || {sql_escape("coalesce(a.title, '')")} || '</h1>'
                         ELSE '' END)
                   || j.body
                   || (CASE WHEN mk.conclusion_seq IS NOT NULL AND mk.conclusion_end IS NULL
                            THEN '{HD.CONCLUSION_END}' ELSE '' END) END AS normalized_html
  FROM v_articles a
  LEFT JOIN joined j USING (article_id)
  LEFT JOIN mk USING (article_id)
  LEFT JOIN (SELECT article_id FROM ({FIX}) WHERE seq = 0) ins USING (article_id)
"""


@register("heading_rewrite", with_views(f"SELECT * FROM ({_REWRITE})", "v_headings", "v_articles"))
def heading_rewrite(spark, sf):
    return HD.normalize_html_structure(V.v_articles(spark, sf)).select("article_id", "normalized_html")


# --- headings inside containers -------------------------------------------------
def _nested(sql: str) -> str:
    return sql.replace("v_headings", "v_nested_headings").replace("v_articles", "v_nested")


@register("heading_containers", with_views(
    "SELECT article_id, seq, level, heading_text, path FROM v_nested_headings", "v_nested", "v_nested_headings"))
def heading_containers(spark, sf):
    hidden = HD.hide_raw(F.col("body_html"))
    n = V.v_nested(spark, sf).select("article_id", hidden.alias("h"))
    rows = F.arrays_zip(HD.heading_levels("h").alias("level"), HD.heading_texts("h").alias("heading_text"),
                        HD.heading_containers(F.col("h")).alias("at"))
    return n.select("article_id", F.posexplode_outer(rows).alias("_i", "_h")).where("_h is not null").select(
        "article_id", (F.col("_i") + 1).alias("seq"), "_h.level", "_h.heading_text", "_h.at.path")


# a section ends at the next heading of the same container
_NESTED_MARKS = _nested(MARKS).replace(
    f"(SELECT article_id, seq, lead(seq) OVER (PARTITION BY article_id ORDER BY seq) AS next_seq\n             FROM ({_nested(NORM)}))",
    "(SELECT article_id, seq, lead(seq) OVER (PARTITION BY article_id, coalesce(path, '') ORDER BY seq) AS next_seq\n"
    f"             FROM ({_nested(NORM)}) LEFT JOIN (SELECT article_id, seq, path FROM v_nested_headings) USING (article_id, seq))")
assert _NESTED_MARKS != _nested(MARKS)


@register("conclusion_scope", with_views(
    f"SELECT article_id, conclusion_seq, conclusion_end FROM ({_NESTED_MARKS}) WHERE conclusion_seq IS NOT NULL",
    "v_nested", "v_nested_headings"))
def conclusion_scope(spark, sf):
    p = HD.with_heading_plan(V.v_nested(spark, sf)).where(F.col("conclusion_at") > 0)
    return p.select(
        "article_id", HD.position_to_seq(F.col("conclusion_at")).alias("conclusion_seq"),
        F.when(F.col("conclusion_end") <= F.size("levels"), HD.position_to_seq(F.col("conclusion_end")))
        .alias("conclusion_end"))


_END = f"CASE WHEN mk.conclusion_seq IS NOT NULL AND mk.conclusion_end IS NULL THEN '{HD.CONCLUSION_END}' ELSE '' END"


@register("nested_rewrite", with_views(f"""
  SELECT * FROM (WITH mk AS ({_NESTED_MARKS}), norm AS ({_nested(NORM)}),
  top AS (SELECT article_id, max(seq) AS n FROM v_headings GROUP BY article_id),
  pieces AS (
    SELECT article_id, i, x, CASE WHEN starts_with(x, '<h') THEN
             row_number() OVER (PARTITION BY article_id, starts_with(x, '<h') ORDER BY i) END AS hseq
    FROM (SELECT article_id, unnest(string_split(body_html, {NL})) AS x,
                 generate_subscripts(string_split(body_html, {NL}), 1) AS i FROM v_nested)),
  written AS (
    SELECT p.article_id, p.i, CASE WHEN p.hseq IS NULL THEN p.x ELSE
             CASE WHEN p.hseq = top.n AND CAST(p.article_id AS BIGINT) % 2 = 0 THEN '{V.NEST_OPEN}' ELSE '' END
             || {_marker_sql('p.hseq')} || '<h' || CAST(nn.level AS VARCHAR) || '>' || p.x[5:-6]
             || '</h' || CAST(nn.level AS VARCHAR) || '>' END AS piece
    FROM pieces p LEFT JOIN mk ON mk.article_id = p.article_id LEFT JOIN top ON top.article_id = p.article_id
    LEFT JOIN norm nn ON nn.article_id = p.article_id AND nn.seq = p.hseq),
  joined AS (SELECT article_id, string_agg(piece, {NL} ORDER BY i) AS body FROM written GROUP BY article_id)
  SELECT a.article_id,
         CASE WHEN ins.article_id IS NOT NULL THEN {_marker_sql('0')} || '<h1>' || {sql_escape("coalesce(a.title, '')")} || '</h1>'
              ELSE '' END || j.body ||
         CASE WHEN CAST(a.article_id AS BIGINT) % 2 = 0
              THEN CASE WHEN mk.conclusion_seq = top.n THEN {_END} ELSE '' END || '{V.NEST_CLOSE}' || {NL}
                   || {_marker_sql('(top.n + 1)')} || '<h' || CAST(nn.level AS VARCHAR) || '>{V.NEST_RELATED[4:-5]}</h'
                   || CAST(nn.level AS VARCHAR) || '>' || CASE WHEN mk.conclusion_seq < top.n THEN {_END} ELSE '' END
              ELSE {NL} || '{V.NEST_SCRIPT[:-4]}' || {_END} || '{V.NEST_SCRIPT[-4:]}' END AS normalized_html
  FROM v_nested a JOIN joined j USING (article_id) JOIN top USING (article_id) LEFT JOIN mk USING (article_id)
  LEFT JOIN norm nn ON nn.article_id = a.article_id AND nn.seq = top.n + 1
  LEFT JOIN (SELECT article_id FROM ({_nested(FIX)}) WHERE seq = 0) ins ON ins.article_id = a.article_id)""", "v_nested", "v_nested_headings", "v_headings"))
def nested_rewrite(spark, sf):
    return HD.normalize_html_structure(V.v_nested(spark, sf)).select("article_id", "normalized_html")
