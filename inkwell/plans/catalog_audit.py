"""Content-rule audit queries (Q1-Q6, Q9, Q10, Q12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import audit as AU
from inkwell.operators import competitors as C
from inkwell.operators import headings as HD
from inkwell.operators import responses as RS
from inkwell.plans import catalog_competitors as CC
from inkwell.plans import catalog_headings as CH
from inkwell.plans import catalog_responses as CR
from inkwell.plans import sqlfrag as Q
from inkwell.plans.oracle_views import with_views
from inkwell.plans.registry import ORACLES, register
from inkwell.sources import views as V

from inkwell.plans import catalog_keywords as CK  # noqa: E402

_T = f"lower({Q.html_to_text('body_html')})"


@register("audit_h1", with_views("""
  SELECT a.article_id, CAST(coalesce(h.n, 0) AS INTEGER) AS h1_count,
         coalesce(contains(lower(h.first), lower(a.target_keyword)), false) AS h1_has_keyword,
         coalesce(h.n, 0) = 1 AND coalesce(contains(lower(h.first), lower(a.target_keyword)), false) AS ok
  FROM v_articles a LEFT JOIN (SELECT article_id, count(*) AS n, arg_min(heading_text, seq) AS first
                               FROM v_headings WHERE level = 1 GROUP BY article_id) h USING (article_id)""",
                                 "v_articles", "v_headings"))
def audit_h1(spark, sf):
    return AU.audit_h1(HD.with_heading_plan(V.v_articles(spark, sf)))


@register("audit_keyword_first_100", with_views(f"""
  SELECT article_id, coalesce(contains(array_to_string(list_filter(regexp_split_to_array({_T}, '\\s+'),
         lambda w: w <> '')[1:{AU.FIRST_WORDS}], ' '), lower(target_keyword)), false) AS ok
  FROM v_articles""", "v_articles"))
def audit_keyword_first_100(spark, sf):
    return AU.audit_keyword_first_100(V.v_articles(spark, sf))


@register("audit_hierarchy", with_views(
    f"SELECT article_id, skips, skips = 0 AS ok FROM ({CH._oracle_skips()})", "v_headings", "v_articles"))
def audit_hierarchy(spark, sf):
    s = HD.heading_skips(HD.with_heading_plan(V.v_articles(spark, sf)))
    return s.select("article_id", "skips", (F.col("skips") == 0).alias("ok"))


@register("audit_topic_copy", with_views(f"""
  SELECT a.article_id, CAST(coalesce(c.n, 0) AS INTEGER) AS copied, coalesce(c.n, 0) = 0 AS ok
  FROM v_articles a LEFT JOIN (
    SELECT h.article_id, count(*) AS n
    FROM v_headings h JOIN v_articles a2 USING (article_id)
    JOIN (SELECT DISTINCT keyword, lower(h2) AS k FROM ({CC._TOPICS_KEPT})) t
      ON t.keyword = a2.target_keyword AND t.k = lower(h.heading_text)
    WHERE h.level = 2 GROUP BY h.article_id) c USING (article_id)""",
                                         "v_articles", "v_headings", "v_serp_responses", "v_web"))
def audit_topic_copy(spark, sf):
    topics = C.h2_topics(C.heading_union(CC._fetched(spark, sf)))
    return AU.audit_topic_copy(V.v_articles(spark, sf), topics)


def _toks(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


_H2S = f"""
  SELECT article_id, keyword, text, i AS seq FROM (
    SELECT article_id, target_keyword AS keyword, unnest(h) AS text, generate_subscripts(h, 1) - 1 AS i
    FROM (SELECT article_id, target_keyword, {Q.tag_texts('body_html', 'h2')} AS h FROM v_articles))"""
_MATCHES = f"""
  SELECT h.article_id, CAST(h.seq AS INTEGER) AS seq, q.question, {_toks('h.text')} = {_toks('q.question')} AS equal
  FROM ({_H2S}) h JOIN (SELECT DISTINCT seed, question FROM ({CK.TOPIC_QUESTIONS})) q
    ON q.seed = h.keyword AND list_has_all({_toks('h.text')}, {_toks('q.question')}) AND len({_toks('q.question')}) > 0"""


@register("question_matches", with_views(_MATCHES, "v_articles", "v_question_reports"))
def question_matches(spark, sf):
    a = V.v_articles(spark, sf)
    h = a.select("article_id", F.col("target_keyword").alias("keyword"),
                 F.posexplode(AU.tag_texts("body_html", "h2")).alias("seq", "text"))
    return AU.question_matches(h, CK.topic_questions(spark, sf).withColumnRenamed("seed", "keyword"))


@register("audit_question_h2", with_views(f"""
  SELECT a.article_id, CAST(len(list_filter({Q.tag_texts('a.body_html', 'h2')}, lambda t: ends_with(t, '?'))) AS INTEGER) AS question_h2s,
         CAST(coalesce(m.n, 0) AS INTEGER) AS matched_h2s, coalesce(m.n, 0) > 0 AS ok
  FROM v_articles a LEFT JOIN (SELECT article_id, count(DISTINCT seq) AS n FROM ({_MATCHES}) GROUP BY article_id) m
  USING (article_id)""", "v_articles", "v_question_reports"))
def audit_question_h2(spark, sf):
    return AU.audit_question_h2(V.v_articles(spark, sf),
                                CK.topic_questions(spark, sf).withColumnRenamed("seed", "keyword"))


@register("audit_keyword_density", with_views(f"""
  SELECT article_id, occurrences, words, density, density >= {AU.DENSITY_MIN} AND density <= {AU.DENSITY_MAX} AS ok
  FROM (SELECT article_id, occurrences, words,
               CASE WHEN words > 0 THEN occurrences * 100.0 / words ELSE 0.0 END AS density
        FROM (SELECT article_id,
                     CASE WHEN length(kw) > 0 THEN CAST(len(list_filter(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+'), lambda w: w = kw)) AS INTEGER)
                          ELSE 0 END AS occurrences,
                     CAST(len(list_filter(regexp_split_to_array(t, '\\s+'), lambda w: w <> '')) AS INTEGER) AS words
              FROM (SELECT article_id, {_T} AS t, lower(target_keyword) AS kw FROM v_articles)))""", "v_articles"))
def audit_keyword_density(spark, sf):
    return AU.audit_keyword_density(V.v_articles(spark, sf))


_DENSITY = f"""
  SELECT keyword, phrase, CAST(count(*) AS INTEGER) AS pages, CAST(sum(n) AS BIGINT) AS occurrences,
         avg(CASE WHEN word_count > 0 THEN n * 100.0 / word_count ELSE 0.0 END) AS density
  FROM (SELECT p.keyword, q.phrase, p.word_count,
               CASE WHEN len(q.w) = 0 THEN 0 ELSE len(list_filter(range(1, len(p.w) - len(q.w) + 2),
                 lambda i: p.w[i:i + len(q.w) - 1] = q.w)) END AS n
        FROM (SELECT keyword, word_count, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM ({CC.TEXTS})) p
        JOIN (SELECT DISTINCT keyword, phrase, regexp_extract_all(lower(phrase), '[\\p{{L}}\\p{{N}}]+') AS w FROM (
                SELECT seed AS keyword, keyword AS phrase FROM ({CK.TOPIC_KEYWORDS})
                UNION ALL SELECT target_keyword, target_keyword FROM v_articles WHERE target_keyword IS NOT NULL)) q
          USING (keyword))
  GROUP BY keyword, phrase"""


def _density(spark, sf):
    top = C.competitor_top(C.search_results_scan(V.v_serp_responses(spark, sf)))
    phrases = CK.topic_keywords(spark, sf).select(F.col("seed").alias("keyword"), F.col("keyword").alias("phrase"))
    own = V.v_articles(spark, sf).where("target_keyword is not null").select(
        F.col("target_keyword").alias("keyword"), F.col("target_keyword").alias("phrase"))
    return AU.competitor_density(C.competitor_texts(top, V.v_web(spark, sf)), phrases.union(own))


@register("competitor_density", with_views(_DENSITY, "v_articles", "v_serp_responses", "v_web", "v_topic_reports"))
def competitor_density(spark, sf):
    return _density(spark, sf)


@register("audit_competitor_density", with_views(f"""
  SELECT o.article_id, o.density, c.density AS competitor_density, coalesce(c.pages, 0) AS pages,
         coalesce(o.density > c.density, false) AS above
  FROM ({ORACLES['audit_keyword_density']}) o JOIN v_articles a USING (article_id)
  LEFT JOIN (SELECT * FROM ({_DENSITY}) WHERE phrase = keyword) c ON c.keyword = a.target_keyword""",
                                                "v_articles", "v_serp_responses", "v_web", "v_topic_reports"))
def audit_competitor_density(spark, sf):
    c = _density(spark, sf).where("phrase = keyword")
    return AU.audit_competitor_density(V.v_articles(spark, sf), c)


_KEYS = "[" + ", ".join(f"'{k}'" for k in AU.OUTPUT_KEYS) + "]"


@register("audit_output_keys", with_views(f"""
  SELECT article_id,
         len(list_filter(json_keys(extracted), lambda k: NOT list_contains({_KEYS}, k))) = 0
           AND len(list_filter({_KEYS}, lambda k: NOT list_contains(json_keys(extracted), k))) = 0 AS keys_ok,
         coalesce(json_extract_string(schema_markup, '$."@type"') = 'BlogPosting'
           AND json_extract(schema_markup, '$.headline') IS NOT NULL
           AND json_extract(schema_markup, '$.description') IS NOT NULL, false) AS schema_ok
  FROM ({CR._PARSED}) WHERE valid""", "v_responses"))
def audit_output_keys(spark, sf):
    return AU.audit_output_keys(RS.parse_responses(V.v_responses(spark, sf)))


def _voice_sql(i: int) -> str:
    parts = []
    for lang, lists in AU.VOICE.items():
        counts = []
        for p in lists[i]:
            if " " in p:  # a pair: words at neighbouring places
                a, b = p.split()
                counts.append(f"len(list_filter(list_zip(tok, tok[2:]), lambda z: z[1] = '{a}' AND z[2] = '{b}'))")
            else:
                counts.append(f"len(list_filter(tok, lambda z: z = '{p}'))")
        parts.append(f"WHEN language = '{lang}' THEN {' + '.join(counts)}")
    return f"CAST(CASE {' '.join(parts)} ELSE 0 END AS INTEGER)"


@register("audit_voice_phrases", with_views(f"""
  SELECT article_id, {_voice_sql(0)} AS avoid_count, {_voice_sql(1)} AS use_count
  FROM (SELECT article_id, source_lang AS language,
               regexp_extract_all({_T}, '[\\p{{L}}\\p{{N}}]+') AS tok FROM v_articles)""", "v_articles"))
def audit_voice_phrases(spark, sf):
    a = V.v_articles(spark, sf).withColumn("language", F.col("source_lang"))
    return AU.audit_voice_phrases(a)


@register("audit_sections", with_views(f"""
  SELECT a.article_id, m.intro_start IS NOT NULL AS intro, m.conclusion_seq IS NOT NULL AS conclusion,
         m.intro_start IS NOT NULL AND m.conclusion_seq IS NOT NULL AS ok
  FROM v_articles a LEFT JOIN ({CH.MARKS}) m USING (article_id)""", "v_articles", "v_headings"))
def audit_sections(spark, sf):
    return AU.audit_sections(HD.with_heading_plan(V.v_articles(spark, sf)))


@register("internal_link_markers", with_views(f"""
  SELECT article_id, CAST(generate_subscripts(t, 1) AS INTEGER) AS marker_no, trim(unnest(t)) AS topic
  FROM (SELECT article_id, regexp_extract_all(optimized_html, '\\[INTERNAL LINK NEEDED:\\s*([^\\]]*)\\]', 1) AS t
        FROM ({CR._PARSED}) WHERE valid)""", "v_responses"))
def internal_link_markers(spark, sf):
    return AU.internal_link_markers(RS.parse_responses(V.v_responses(spark, sf)))


_STOPS = "[" + ", ".join(f"'{w}'" for w in AU.SLUG_STOP_WORDS) + "]"


@register("audit_metadata", with_views(f"""
  SELECT article_id, title_ok, meta_ok, slug_ok, og_ok, title_ok AND meta_ok AND slug_ok AND og_ok AS ok
  FROM (SELECT p.article_id,
          coalesce(length(title_tag) BETWEEN 50 AND 60 AND starts_with(lower(title_tag), lower(a.target_keyword)), false) AS title_ok,
          coalesce(length(meta_description) BETWEEN 150 AND 160 AND contains(lower(meta_description), lower(a.target_keyword)), false) AS meta_ok,
          coalesce(regexp_full_match(slug, '{AU.SLUG_RE.strip("^$")}') AND contains(slug, replace(lower(a.target_keyword), ' ', '-'))
                   AND NOT list_has_any(string_split(slug, '-'), {_STOPS}), false) AS slug_ok,
          coalesce(length(og_description) BETWEEN 150 AND 200 AND og_description <> meta_description, false) AS og_ok
        FROM ({CR._PARSED}) p LEFT JOIN v_articles a USING (article_id) WHERE p.valid)""",
                                       "v_responses", "v_articles"))
def audit_metadata(spark, sf):
    parsed = RS.parse_responses(V.v_responses(spark, sf))
    kw = V.v_articles(spark, sf).select("article_id", F.col("target_keyword").alias("keyword"))
    return AU.audit_metadata(parsed.join(kw, "article_id", "left"))


@register("alt_text_rows", with_views(f"""
  SELECT article_id, image, alt_text, coalesce(contains(lower(alt_text), lower(target_keyword)), false) AS has_keyword
  FROM (SELECT p.article_id, a.target_keyword, unnest(['hero.jpg', 'detail.jpg']) AS image,
               unnest([json_extract_string(extracted, '$.alt_texts."hero.jpg"'),
                       json_extract_string(extracted, '$.alt_texts."detail.jpg"')]) AS alt_text
        FROM ({CR._PARSED}) p LEFT JOIN v_articles a USING (article_id) WHERE p.valid)""", "v_responses", "v_articles"))
def alt_text_rows(spark, sf):
    kw = V.v_articles(spark, sf).select("article_id", F.col("target_keyword").alias("keyword"))
    return AU.alt_text_rows(RS.parse_responses(V.v_responses(spark, sf)).join(kw, "article_id", "left"))


@register("audit_secondary_headings", with_views(f"""
  SELECT a.article_id, CAST(coalesce(c.n, 0) AS INTEGER) AS headings_with_secondary, coalesce(c.n, 0) >= 2 AS ok
  FROM v_articles a LEFT JOIN (
    SELECT h.article_id, count(DISTINCT h.seq) AS n
    FROM v_headings h JOIN v_articles t USING (article_id) JOIN ({CK.TOPIC_KEYWORDS}) s ON s.seed = t.target_keyword
    WHERE h.level IN (2, 3) AND contains(lower(h.heading_text), lower(s.keyword))
    GROUP BY h.article_id) c USING (article_id)""", "v_articles", "v_headings", "v_topic_reports"))
def audit_secondary_headings(spark, sf):
    plan = HD.with_heading_plan(V.v_articles(spark, sf))
    rows = F.arrays_zip(F.col("raw_levels").alias("level"), F.col("_t").alias("heading_text"))
    heads = (plan.withColumn("_t", F.when(F.col("h1_inserted"), F.slice("fixed_texts", 2, 1 << 30))
                             .otherwise(F.col("fixed_texts")))
             .select("article_id", F.col("target_keyword").alias("seed"), F.posexplode_outer(rows).alias("_i", "_h"))
             .select("article_id", "seed", (F.col("_i") + 1).alias("seq"),
                     F.col("_h.level").alias("level"), F.col("_h.heading_text").alias("heading_text")))
    return AU.audit_secondary_headings(heads, CK.topic_keywords(spark, sf))
