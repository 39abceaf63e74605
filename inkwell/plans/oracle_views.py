"""DuckDB twins of the canonical views (``inkwell.sources.views``).

The checker pre-registers only the raw driver tables, so every oracle query is
``WITH <views it needs> <query>``.  These strings are written independently of
the Spark code: they are the specification the Spark side is tested against.
"""

from __future__ import annotations

from inkwell.functions.signatures import key_pads
from inkwell.sources.views import (
    DEFAULT_STORE_SECRET,
    DEFAULT_TASKS_SECRET,
    DELIVERY_MINUTES,
    KEYWORD_REPORT_HEADER,
    NEST_RELATED,
    OVERVIEW_REPORT_HEADER,
    REPORT_PAGE_ROWS,
    WRONG_SIGNATURE,
    PROMPTS,
)

NL = "chr(10)"


def sql_hmac_hex(expr: str, secret: str) -> str:
    ipad, opad = key_pads(secret)
    return (f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || "
            f"encode({expr}))))")


def sql_hmac_base64(expr: str, secret: str) -> str:
    return f"to_base64(unhex({sql_hmac_hex(expr, secret)}))"


def sql_escape(expr: str) -> str:
    return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _q(s: str) -> str:
    return s.replace("'", "''")


_DOC_LINES = f"""
  SELECT doc_id, text, lang, string_split(text, {NL}) AS lines,
         list_max(list_transform(string_split(text, {NL}),
           lambda x, i: CASE WHEN (i - 1) % 3 = 0 AND x <> '' THEN i - 1 ELSE -1 END)) AS last_h
  FROM documents
"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}

VIEWS["v_doc_lines"] = (_DOC_LINES, ())

VIEWS["v_articles"] = (f"""
  SELECT CAST(doc_id AS VARCHAR) AS article_id,
         CAST(doc_id % 3 AS VARCHAR) AS blog_id,
         CASE WHEN doc_id % 4 = 0 THEN 'published' ELSE 'draft' END AS status,
         lines[1] AS title,
         CASE WHEN doc_id % 13 = 0 THEN NULL
              ELSE lower(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')[2]) END AS target_keyword,
         array_to_string(list_filter(list_transform(lines, lambda x, i:
             CASE WHEN x = '' THEN NULL
                  WHEN (i - 1) % 3 = 0 THEN
                    '<h' || CAST(1 + (doc_id * 7 + (i - 1) * 3) % 4 AS VARCHAR) || '>' ||
                    CASE WHEN doc_id % 5 = 0 AND i - 1 = last_h
                         THEN (CASE WHEN lang = 'fr' THEN 'Résumé' ELSE 'Conclusion' END)
                         ELSE {sql_escape('x')} END ||
                    '</h' || CAST(1 + (doc_id * 7 + (i - 1) * 3) % 4 AS VARCHAR) || '>'
                  ELSE '<p>' || {sql_escape('x')} || '</p>' END),
           lambda p: p IS NOT NULL), {NL}) AS body_html,
         lang AS source_lang
  FROM v_doc_lines
""", ("v_doc_lines",))

VIEWS["v_headings"] = ("""
  SELECT article_id,
         CAST(row_number() OVER (PARTITION BY article_id ORDER BY i) AS INTEGER) AS seq,
         level, heading_text
  FROM (
    SELECT CAST(doc_id AS VARCHAR) AS article_id, i,
           CAST(1 + (doc_id * 7 + i * 3) % 4 AS INTEGER) AS level,
           CASE WHEN doc_id % 5 = 0 AND i = last_h
                THEN (CASE WHEN lang = 'fr' THEN 'Résumé' ELSE 'Conclusion' END)
                ELSE trim(x) END AS heading_text,
           x
    FROM (SELECT doc_id, lang, last_h, unnest(lines) AS x,
                 generate_subscripts(lines, 1) - 1 AS i FROM v_doc_lines)
  ) WHERE i % 3 = 0 AND x <> ''
""", ("v_doc_lines",))

VIEWS["v_webhooks"] = (f"""
  SELECT CAST(article_id AS BIGINT) * 2 + copy AS delivery_id, payload,
         CASE WHEN CAST(article_id AS BIGINT) % 11 = 0 THEN '{WRONG_SIGNATURE}'
              ELSE {sql_hmac_base64('payload', DEFAULT_STORE_SECRET)} END AS signature
  FROM (
    SELECT *, unnest(CASE WHEN CAST(article_id AS BIGINT) % 6 = 0 THEN [0, 1] ELSE [0] END) AS copy,
           CASE WHEN CAST(article_id AS BIGINT) % 17 = 0 THEN left(js, length(js) - 5) ELSE js END AS payload
    FROM (
      SELECT *, CAST(json_object('id', CAST(article_id AS BIGINT), 'title', title, 'status', status,
                                 'blog_id', CAST(blog_id AS BIGINT), 'body_html', body_html) AS VARCHAR) AS js
      FROM v_articles)
  )
""", ("v_articles",))

VIEWS["v_nested"] = ("""
  SELECT a.* FROM v_articles a WHERE article_id IN (SELECT article_id FROM v_headings)
""", ("v_articles", "v_headings"))

# headings of the nested articles with the element that holds them
VIEWS["v_nested_headings"] = (f"""
  SELECT h.article_id, h.seq, h.level, h.heading_text,
         CASE WHEN even AND h.seq = n THEN 'section/div' ELSE '' END AS path
  FROM v_headings h JOIN (
    SELECT article_id, max(seq) AS n, CAST(article_id AS BIGINT) % 2 = 0 AS even FROM v_headings GROUP BY article_id) USING (article_id)
  UNION ALL
  SELECT article_id, CAST(max(seq) + 1 AS INTEGER), 3, '{NEST_RELATED[4:-5]}', '' FROM v_headings
  WHERE CAST(article_id AS BIGINT) % 2 = 0 GROUP BY article_id
""", ("v_headings",))

VIEWS["v_deliveries"] = (f"""
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(
           (delivery_id // 2 * 7919) % {DELIVERY_MINUTES}
           + (delivery_id % 2) * CASE WHEN delivery_id // 2 % 12 = 0 THEN 10 ELSE {DELIVERY_MINUTES} END AS BIGINT)) AS delivered_at
  FROM v_webhooks
""", ("v_webhooks",))

VIEWS["v_keywords"] = ("""
  SELECT p_brand AS seed,
         CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INTEGER) AS pos,
         p_name AS keyword,
         CAST(floor(p_retailprice) AS BIGINT) AS volume,
         CASE WHEN p_partkey % 19 = 0 THEN 0.0 ELSE CAST(p_size AS DOUBLE) END AS difficulty
  FROM part
""", ())

VIEWS["v_keyword_reports"] = (f"""
  SELECT seed, CAST((pos - 1) // {REPORT_PAGE_ROWS} AS INTEGER) AS page,
         '{KEYWORD_REPORT_HEADER}' || {NL} || string_agg(
           CASE WHEN pos % 23 = 0 THEN keyword
                ELSE keyword || ';' || (CASE WHEN pos % 7 = 0 THEN 'N/A' ELSE CAST(volume AS VARCHAR) END)
                     || ';' || CAST(CAST(difficulty AS BIGINT) AS VARCHAR) END,
           {NL} ORDER BY pos) AS report
  FROM v_keywords GROUP BY seed, (pos - 1) // {REPORT_PAGE_ROWS}
""", ("v_keywords",))

VIEWS["v_overview_reports"] = (f"""
  SELECT p_partkey AS report_id, p_name AS seed,
         CASE WHEN p_partkey % 11 = 0 THEN '{OVERVIEW_REPORT_HEADER}'
              ELSE '{OVERVIEW_REPORT_HEADER}' || {NL} || p_name || ';' ||
                   (CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END) ||
                   (CASE WHEN p_partkey % 13 = 0 THEN ''
                         ELSE ';' || CAST(p_size AS VARCHAR) || ';' || CAST(p_size AS VARCHAR) || '.' ||
                              lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') END)
         END AS report
  FROM part
""", ())

VIEWS["v_web"] = ("""
  SELECT p.page_id * 2 AS web_id, a.target_keyword AS keyword, p.url, p.html
  FROM pages p LEFT JOIN v_articles a ON CAST(a.article_id AS BIGINT) = p.page_id
  UNION ALL
  SELECT CAST(article_id AS BIGINT) * 2 + 1 AS web_id, target_keyword AS keyword,
         'https://blog.example.org/' || article_id AS url, body_html AS html
  FROM v_articles
""", ("v_articles",))

VIEWS["v_serp"] = ("""
  SELECT keyword,
         CAST(row_number() OVER (PARTITION BY keyword ORDER BY web_id) AS INTEGER) AS position,
         url AS link, web_id
  FROM v_web WHERE keyword IS NOT NULL
""", ("v_web",))

VIEWS["v_serp_responses"] = ("""
  SELECT web_id AS response_id, keyword, position,
         CAST(json_object('searchParameters', json_object('q', keyword),
              'organic', list_concat(
                  CASE WHEN web_id % 5 = 0 THEN [json_object('link', 'https://en.wikipedia.org/wiki/' || keyword,
                                                             'position', position * 10)] ELSE [] END,
                  [json_object('link', link, 'position', position * 10 + 1)],
                  CASE WHEN web_id % 4 = 0 THEN [json_object('position', position * 10 + 2)] ELSE [] END,
                  CASE WHEN web_id % 7 = 0 THEN [json_object('link', 'https://offline.example.invalid/' || CAST(web_id AS VARCHAR),
                                                             'position', position * 10 + 3)] ELSE [] END))
              AS VARCHAR) AS response
  FROM v_serp
""", ("v_serp",))

VIEWS["v_scores"] = ("""
  SELECT CAST(o_orderkey AS VARCHAR) AS article_id,
         CASE WHEN o_orderkey % 29 = 0 THEN 0.0 ELSE round(o_totalprice % 101, 2) END AS initial,
         round((o_totalprice * 3) % 101, 2) AS final
  FROM orders
""", ())

VIEWS["v_polls"] = ("""
  SELECT CAST(user_id AS VARCHAR) AS doc_id, ts, event_id,
         CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'pending' END AS status,
         value AS content_score,
         CASE WHEN event_id % 4 <> 0 THEN ['term ' || (event_id % 7), 'term ' || (event_id % 11 + 7)] END AS lsi_keywords,
         CASE WHEN event_id % 3 <> 0 THEN ['Part ' || (event_id % 5)] END AS suggested_headings,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS attempt
  FROM events
""", ())

VIEWS["v_matches"] = ("""
  SELECT CAST(l_orderkey AS VARCHAR) AS article_id, l_linenumber AS match_no,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 5 = 0 THEN 'n/a'
              ELSE CAST(l_quantity AS VARCHAR) END AS percentmatched,
         CASE WHEN l_linenumber % 6 = 0 THEN NULL
              ELSE CAST(round(l_tax * 100, 2) AS VARCHAR) END AS minper,
         CAST(round(l_discount * 100, 2) AS VARCHAR) AS percent
  FROM lineitem
""", ())


def _slug_words(expr: str, n: int) -> str:
    return (f"array_to_string(regexp_extract_all(lower({expr}), '[\\p{{L}}\\p{{N}}]+')[1:{n}], '-')")


_FIRST = f"string_split(text, {NL})[1]"
_KEY = "(conv_id * 8 + turn)"
_KW = "coalesce(a.target_keyword, 'none')"
_TITLE = f"{_KW} || ' ' || replace(text, {NL}, ' ')"


def _body(og_title: str) -> str:
    return f"""CAST(json_object(
    'optimized_html', '<h1>' || {sql_escape(_FIRST)} || '</h1>' || {NL} || '<p>' || {sql_escape('text')} || '</p>'
        || CASE WHEN {_KEY} % 3 = 0
                THEN {NL} || '<p>See [INTERNAL LINK NEEDED: ' || {_slug_words('text', 2)} || ']</p>' ELSE '' END,
    'title_tag', CASE {_KEY} % 3 WHEN 0 THEN substr({_TITLE}, 1, 55) WHEN 1 THEN {_FIRST} ELSE {_TITLE} END,
    'meta_description', CASE {_KEY} % 4 WHEN 1 THEN substr({_TITLE}, 1, 155) WHEN 3 THEN text ELSE substr(text, 1, 155) END,
    'slug', CASE WHEN {_KEY} % 5 < 3 THEN {_KW} || '-guide-' || CAST({_KEY} AS VARCHAR) ELSE {_slug_words('text', 4)} END,
    {og_title}
    'og_description', CASE WHEN {_KEY} % 6 = 0 THEN text ELSE substr(text, 1, 180) END,
    'schema_markup', json_object('@type', CASE WHEN {_KEY} % 7 = 0 THEN 'Article' ELSE 'BlogPosting' END,
                                 'headline', {_FIRST}, 'description', text),
    'alt_texts', json_object('hero.jpg', {_FIRST}, 'detail.jpg', 'Photo of ' || {_KW}),
    'internal_link_suggestions', [json_object('location', 'introduction',
                                              'suggested_topic', {_slug_words('text', 2)})],
    'changes_summary', 'Rewrote turn ' || CAST({_KEY} AS VARCHAR)) AS VARCHAR)"""


VIEWS["v_responses"] = (f"""
  SELECT article_id,
         CASE conv_id % 4 WHEN 0 THEN body
                          WHEN 1 THEN '```json' || {NL} || body || {NL} || '```'
                          WHEN 2 THEN '```' || {NL} || body
                          ELSE left(body, length(body) - 7) END AS raw
  FROM (SELECT CAST({_KEY} AS VARCHAR) AS article_id, conv_id,
               CASE WHEN {_KEY} % 11 = 0 THEN {_body('')} ELSE {_body(f"'og_title', {_FIRST},")} END AS body
        FROM conversations c LEFT JOIN v_articles a ON a.article_id = CAST({_KEY} AS VARCHAR) WHERE c.role = 'assistant')
""", ("v_articles",))

VIEWS["v_topic_lines"] = (f"""
  SELECT seed, doc_id, words, CAST(row_number() OVER (PARTITION BY seed ORDER BY doc_id) AS INTEGER) AS pos FROM (
    SELECT doc_id, lower(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')[2]) AS seed,
           regexp_extract_all(lower(coalesce(nullif(string_split(text, {NL})[4], ''), string_split(text, {NL})[1])),
                              '[\\p{{L}}\\p{{N}}]+') AS words
    FROM documents WHERE doc_id % 13 <> 0)
  WHERE seed IS NOT NULL AND len(words) > 0
""", ())


def _pages(line: str, header: str) -> str:
    return f"""
  SELECT seed, CAST((pos - 1) // {REPORT_PAGE_ROWS} AS INTEGER) AS page,
         '{header}' || {NL} || string_agg({line}, {NL} ORDER BY pos) AS report
  FROM v_topic_lines GROUP BY seed, (pos - 1) // {REPORT_PAGE_ROWS}"""


VIEWS["v_topic_reports"] = (_pages(
    "array_to_string(words[1:2], ' ') || ';' || CAST(doc_id * 31 % 997 + 1 AS VARCHAR) || ';' || CAST(doc_id % 50 AS VARCHAR)",
    KEYWORD_REPORT_HEADER), ("v_topic_lines",))

VIEWS["v_question_reports"] = (_pages(
    "CASE doc_id % 4 WHEN 0 THEN array_to_string(words, ' ') || '?' WHEN 2 THEN array_to_string(words[1:3], ' ') || ' ?' "
    "ELSE 'What is ' || seed || '?' END", "Keyword"), ("v_topic_lines",))

VIEWS["v_stories"] = ("""
  SELECT CAST(conv_id AS VARCHAR) AS task_gid,
         CAST(conv_id * 1000 + turn AS VARCHAR) AS story_gid,
         CASE turn % 4 WHEN 0 THEN 'APPROVE'
                       WHEN 1 THEN 'reject : ' || text
                       WHEN 2 THEN 'REJECT'
                       ELSE text END AS text
  FROM conversations WHERE role = 'user'
""", ())

VIEWS["v_comment_events"] = (f"""
  SELECT delivery_id, payload,
         CASE WHEN delivery_id % 7 = 3 THEN '{WRONG_SIGNATURE}'
              ELSE {sql_hmac_hex('payload', DEFAULT_TASKS_SECRET)} END AS signature
  FROM (
    SELECT CAST(story_gid AS BIGINT) AS delivery_id,
           CAST(json_object('events', [
             json_object('action', CASE WHEN CAST(story_gid AS BIGINT) % 5 = 4 THEN 'removed' ELSE 'added' END,
                         'resource', json_object('resource_type', 'story', 'gid', story_gid),
                         'parent', json_object('gid', task_gid)),
             json_object('action', 'changed',
                         'resource', json_object('resource_type', 'task', 'gid', task_gid),
                         'parent', json_object())]) AS VARCHAR) AS payload
    FROM v_stories)
""", ("v_stories",))

_RUN_KNOWN = {
    "id": "o_orderkey",
    "article_id": "CAST(o_orderkey * 2 + 1 AS VARCHAR)",
    "blog_id": "CAST(o_orderkey % 3 AS VARCHAR)",
    "title": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Article ' || CAST(o_orderkey AS VARCHAR) END",
    "language": "CASE WHEN o_orderkey % 4 = 0 THEN 'fr' ELSE 'en' END",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'awaiting_approval' WHEN 'P' THEN 'pending' END",
    "asana_task_gid": "CAST(o_custkey AS VARCHAR)",
    "created_at": "o_orderdate",
    "updated_at": "o_orderdate",
}
_DUCK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
               "timestamp_ntz": "TIMESTAMP"}


def _runs_sql() -> str:
    from inkwell.sources.views import RUN_COLUMNS
    cols = ",\n         ".join(
        f"CAST({_RUN_KNOWN.get(n, 'NULL')} AS {_DUCK_TYPES[t]}) AS {n}" for n, t in RUN_COLUMNS)
    return f"SELECT {cols}\n  FROM orders"


VIEWS["v_runs"] = (_runs_sql(), ())

VIEWS["v_run_events"] = ("""
  SELECT CAST(user_id AS VARCHAR) AS article_id, ts, event_id,
         CASE WHEN event_type = 'signup' THEN 'created' WHEN event_type = 'view' THEN 'started'
              WHEN event_type = 'purchase' THEN 'scored' WHEN event_type = 'click' THEN 'approve'
              WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'reject'
              WHEN event_type = 'error' THEN 'failed' END AS action,
         CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'note ' || event_id END AS reason
  FROM events
""", ())

VIEWS["v_metafields"] = ("""
  SELECT article_id, 1 AS pos, 'global' AS namespace, 'title_tag' AS key, title AS value FROM v_articles
  UNION ALL
  SELECT article_id, 2, 'seo', 'target_keyword', coalesce(target_keyword, '') FROM v_articles
  UNION ALL
  SELECT article_id, 3, 'seo', 'target_keyword', 'later-' || article_id FROM v_articles
  WHERE CAST(article_id AS BIGINT) % 7 = 0
""", ("v_articles",))

VIEWS["v_doc_responses"] = ("""
  SELECT o_orderkey AS response_id,
         CASE WHEN o_orderkey % 3 = 0 THEN '{"id": "doc-' || CAST(o_orderkey AS VARCHAR) || '"}'
              WHEN o_orderkey % 3 = 1 THEN '{"data": {"id": "nested-' || CAST(o_orderkey AS VARCHAR) || '"}}'
              WHEN o_orderkey % 5 = 0 THEN '{"id": "", "data": {"id": "nested-' || CAST(o_orderkey AS VARCHAR) || '"}}'
              ELSE '{}' END AS response
  FROM orders
""", ())

VIEWS["v_corpus"] = ("SELECT item_id AS source_id, text FROM benchmark", ())

VIEWS["v_prompts"] = (
    "SELECT * FROM (VALUES " + ", ".join(
        f"('{_q(a)}', '{_q(b).replace(chr(10), "' || chr(10) || '")}', '{_q(c)}')" for a, b, c in PROMPTS
    ) + ") AS t(language, system_prompt, brand_voice)", ())


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` and their dependencies."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in ordered)
    return f"WITH {ctes}\n{sql}"
