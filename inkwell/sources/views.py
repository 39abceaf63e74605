"""Canonical views: deterministic projections of the driver tables onto the
shapes the operators consume (FIXTURES.md Part B).  Each view has a DuckDB twin
in ``inkwell.plans.oracle_views``; only modulo arithmetic on ids is used.

Outside services are replaced by staged tables, so every "response" here is
data derived from the driver tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.html import escape_text
from inkwell.functions.signatures import hmac_sha256_base64, hmac_sha256_hex
from inkwell.operators.sequence import number_within
from inkwell.sources.tables import read_table

# The secrets the staged event feeds are signed with (job
# parameters; these defaults exist for the fixtures only).
DEFAULT_STORE_SECRET = "store-webhook-secret"
DEFAULT_TASKS_SECRET = "tasks-webhook-secret"
WRONG_SIGNATURE = "not-a-valid-signature"

# Header lines of the staged keyword reports.
KEYWORD_REPORT_HEADER = "Keyword;Search Volume;Keyword Difficulty"
OVERVIEW_REPORT_HEADER = "Keyword;Search Volume;Keyword Difficulty;CPC"
REPORT_PAGE_ROWS = 20  # rows per staged report (the keyword service's display limit)


def _second_word(text: str) -> F.Column:
    """The second word of a text, null if it has none; only the beginning of the
    text is read."""
    return F.nullif(F.regexp_extract(
        text, r"\A[^\p{L}\p{N}]*+[\p{L}\p{N}]++[^\p{L}\p{N}]++([\p{L}\p{N}]++)", 1), F.lit(""))


def v_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Draft articles built from ``documents``: every third non-empty line is a
    heading of a level derived from the id, the others are paragraphs."""
    d = read_table(spark, sf, "documents")
    doc = F.col("doc_id")
    closing_word = F.when(F.col("lang") == "fr", F.lit("Résumé")).otherwise(F.lit("Conclusion"))

    def piece(x, i, last):
        level = (F.lit(1) + (doc * 7 + i * 3) % 4).cast("string")
        head_text = F.when((doc % 5 == 0) & (i == last), closing_word).otherwise(escape_text(x))
        return (
            F.when(x == "", F.lit(None))
            .when(i % 3 == 0, F.concat(F.lit("<h"), level, F.lit(">"), head_text,
                                       F.lit("</h"), level, F.lit(">")))
            .otherwise(F.concat(F.lit("<p>"), escape_text(x), F.lit("</p>")))
        )

    def body(lines):
        # the lines and the last heading are bound, so they are found once a text
        last = F.array_max(F.transform(lines, lambda x, i: F.when((i % 3 == 0) & (x != ""), i).otherwise(-1)))
        return F.transform(F.array(last), lambda at: F.array_join(F.filter(
            F.transform(lines, lambda x, i: piece(x, i, at)), lambda p: p.isNotNull()), "\n"))[0]

    return d.select(
        F.col("doc_id").cast("string").alias("article_id"),
        (doc % 3).cast("string").alias("blog_id"),
        F.when(doc % 4 == 0, "published").otherwise("draft").alias("status"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(doc % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.lower(_second_word("text"))).alias("target_keyword"),
        F.transform(F.array(F.split("text", "\n", -1)), body)[0].alias("body_html"),
        F.col("lang").alias("source_lang"),
    )


def v_webhooks(spark: SparkSession, sf: str, secret: str = DEFAULT_STORE_SECRET) -> DataFrame:
    """Signed article events.  Every 17th payload is truncated (malformed),
    every 11th carries a wrong signature, every 6th is delivered twice."""
    a = v_articles(spark, sf)
    doc = F.col("article_id").cast("bigint")
    js = F.to_json(F.struct(
        doc.alias("id"), F.col("title"), F.col("status"),
        F.col("blog_id").cast("bigint").alias("blog_id"), F.col("body_html"),
    ))
    payload = F.when(doc % 17 == 0, F.expr("substring(_js, 1, char_length(_js) - 5)")).otherwise(
        F.col("_js"))
    return (
        a.withColumn("_js", js)
        .withColumn("payload", payload)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(doc % 6 == 0, 1).otherwise(0))))
        .select(
            (doc * 2 + F.col("copy")).alias("delivery_id"),
            F.col("payload"),
            F.when(doc % 11 == 0, F.lit(WRONG_SIGNATURE))
            .otherwise(hmac_sha256_base64(F.col("payload"), secret)).alias("signature"),
        )
    )


# What the nested articles are wrapped in.
NEST_OPEN = '<section><div class="a>b">'
NEST_CLOSE = "</div><!-- <h2>Conclusion</h2> --><p>after</p></section>"
NEST_RELATED = "<h3>Related</h3>"
NEST_SCRIPT = "<script>var s = \"<h2>Conclusion</h2>\";</script>tail"


def v_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with a heading whose last section (from its last heading on)
    lies in containers, before a further heading outside them (even ids), or
    whose end is a script that looks like a heading (odd ids)."""
    # the pieces come from a generator: a filter on them does not write the body again
    a = v_articles(spark, sf).select("*", F.inline(F.array(F.struct(F.split("body_html", "\n", -1).alias("_p")))))
    last = F.array_max(F.transform("_p", lambda p, i: F.when(p.startswith("<h"), i + 1).otherwise(0)))
    inner = F.concat(F.lit(NEST_OPEN), F.array_join(F.slice("_p", F.col("_at"), 1 << 30), "\n"), F.lit(NEST_CLOSE))
    wrapped = F.array_join(F.concat(F.slice("_p", F.lit(1), F.col("_at") - 1), F.array(inner, F.lit(NEST_RELATED))), "\n")
    even = F.col("article_id").cast("bigint") % 2 == 0
    return a.withColumn("_at", last).where(F.col("_at") > 0).withColumn(
        "body_html", F.when(even, wrapped).otherwise(F.concat("body_html", F.lit("\n" + NEST_SCRIPT)))).drop("_p", "_at")


#: Minutes over which the staged deliveries are spread.
DELIVERY_MINUTES = 14_400


def v_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Article events with their delivery time.  A second delivery comes ten
    minutes after the first (every 12th article) or ten days after it."""
    doc, copy = F.floor(F.col("delivery_id") / 2), F.col("delivery_id") % 2
    minutes = (doc * 7919) % DELIVERY_MINUTES + copy * F.when(doc % 12 == 0, 10).otherwise(DELIVERY_MINUTES)
    return v_webhooks(spark, sf).withColumn(
        "delivered_at", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(mins=minutes.cast("int")))


def v_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Related-keyword rows per seed with their report position."""
    p = read_table(spark, sf, "part")
    base = p.select(
        F.col("p_brand").alias("seed"),
        F.col("p_partkey"),
        F.col("p_name").alias("keyword"),
        F.floor("p_retailprice").cast("bigint").alias("volume"),
        F.when(F.col("p_partkey") % 19 == 0, F.lit(0.0))
        .otherwise(F.col("p_size").cast("double")).alias("difficulty"),
    )
    return number_within(base, ["seed"], ["p_partkey"], "pos").select(
        "seed", "pos", "keyword", "volume", "difficulty"
    )


def keyword_report_line() -> F.Column:
    vol = F.when(F.col("pos") % 7 == 0, F.lit("N/A")).otherwise(F.col("volume").cast("string"))
    return F.when(F.col("pos") % 23 == 0, F.col("keyword")).otherwise(
        F.concat_ws(";", "keyword", vol, F.col("difficulty").cast("bigint").cast("string"))
    )


def _report_pages(lines: DataFrame, header: str) -> DataFrame:
    """(seed, page, report) from (seed, pos, line), a page of
    ``REPORT_PAGE_ROWS`` lines each."""
    grouped = lines.withColumn("page", ((F.col("pos") - 1) / REPORT_PAGE_ROWS).cast("int")).groupBy("seed", "page").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("_l"))
    return grouped.select("seed", "page", F.concat_ws("\n", F.lit(header), F.col("_l.line")).alias("report"))


def _topic_lines(spark: SparkSession, sf: str, line: F.Column) -> DataFrame:
    """(seed, pos, line) per article with a keyword, numbered within the
    keyword; ``line`` is made of ``seed``, ``doc_id`` and ``words``, the words of
    the article's second heading line (of its first, if there is none), in lower
    case."""
    d = read_table(spark, sf, "documents").where(F.col("doc_id") % 13 != 0)
    lines = F.split("text", "\n", 5)  # the first four and the rest
    heading = F.coalesce(F.nullif(F.get(lines, F.lit(3)), F.lit("")), F.get(lines, F.lit(0)))
    words = F.regexp_extract_all(F.lower(heading), F.lit(r"[\p{L}\p{N}]+"), 0)
    base = d.select(F.lower(_second_word("text")).alias("seed"), "doc_id", words.alias("words")).where("seed is not null and size(words) > 0")
    return number_within(base.select("seed", "doc_id", line.alias("line")), ["seed"], ["doc_id"], "pos")


def v_topic_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Related-keyword reports of the articles' own keywords: the first two
    words of a heading of each article with this keyword."""
    doc = F.col("doc_id")
    line = F.concat_ws(";", F.array_join(F.slice("words", 1, 2), " "), ((doc * 31) % 997 + 1).cast("string"),
                       (doc % 50).cast("string"))
    return _report_pages(_topic_lines(spark, sf, line), KEYWORD_REPORT_HEADER)


def v_question_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Question-keyword reports of the articles' own keywords: a heading of the
    article as a question (every fourth), three words of it, or a question
    about the keyword."""
    m = F.col("doc_id") % 4
    line = F.when(m == 0, F.concat(F.array_join("words", " "), F.lit("?"))) \
        .when(m == 2, F.concat(F.array_join(F.slice("words", 1, 3), " "), F.lit(" ?"))) \
        .otherwise(F.concat(F.lit("What is "), F.col("seed"), F.lit("?")))
    return _report_pages(_topic_lines(spark, sf, line), "Keyword")


def v_keyword_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Staged related-keyword reports: one report per (seed, page) holding at
    most ``REPORT_PAGE_ROWS`` lines, as the keyword service pages them.  Each
    report row is bounded, whatever the size of a seed."""
    return _report_pages(v_keywords(spark, sf).select("seed", "pos", keyword_report_line().alias("line")),
                         KEYWORD_REPORT_HEADER)


def v_overview_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Staged keyword-overview reports, one per part: header + one data row.
    Every 11th is header-only, every 13th has two fields, every 7th an
    unparsable volume."""
    p = read_table(spark, sf, "part")
    key = F.col("p_partkey")
    vol = F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.floor("p_retailprice").cast("bigint").cast("string"))
    cpc = F.concat(F.col("p_size").cast("string"), F.lit("."),
                   F.lpad((key % 100).cast("string"), 2, "0"))
    row = F.when(key % 13 == 0, F.concat_ws(";", F.col("p_name"), vol)).otherwise(
        F.concat_ws(";", F.col("p_name"), vol, F.col("p_size").cast("string"), cpc))
    report = F.when(key % 11 == 0, F.lit(OVERVIEW_REPORT_HEADER)).otherwise(
        F.concat_ws("\n", F.lit(OVERVIEW_REPORT_HEADER), row))
    return p.select(key.alias("report_id"), F.col("p_name").alias("seed"), report.alias("report"))


ARTICLE_URL_PREFIX = "https://blog.example.org/"
SKIPPED_RESULT_URL = "https://en.wikipedia.org/wiki/"
UNREACHABLE_URL = "https://offline.example.invalid/"


def v_web(spark: SparkSession, sf: str, articles: DataFrame | None = None) -> DataFrame:
    """The crawlable web: raw ``pages`` plus the articles served as pages.
    Each document is a search result for one keyword: a page for the target
    keyword of the document with the same id, an article for its own."""
    a = v_articles(spark, sf)
    p = read_table(spark, sf, "pages")
    kw = a.select(F.col("article_id").cast("bigint").alias("page_id"),
                  F.col("target_keyword").alias("keyword"))
    pages = p.join(kw, "page_id", "left").select(
        (F.col("page_id") * 2).alias("web_id"), "keyword", F.col("url"), F.col("html"))
    arts = a.select(
        (F.col("article_id").cast("bigint") * 2 + 1).alias("web_id"),
        F.col("target_keyword").alias("keyword"),
        F.concat(F.lit(ARTICLE_URL_PREFIX), F.col("article_id")).alias("url"),
        F.col("body_html").alias("html"),
    )
    return pages.unionByName(arts)


def v_serp(spark: SparkSession, sf: str, articles: DataFrame | None = None) -> DataFrame:
    """Organic search results: every web document with a keyword, ranked by
    ``web_id`` inside the keyword (a common keyword is a hot group)."""
    w = v_web(spark, sf, articles).where(F.col("keyword").isNotNull()).select(
        "keyword", "web_id", F.col("url").alias("link"))
    return number_within(w, ["keyword"], ["web_id"], "position").select(
        "keyword", "position", "link", "web_id"
    )


def v_serp_responses(spark: SparkSession, sf: str, articles: DataFrame | None = None) -> DataFrame:
    """Staged search responses, one JSON document per result.  Around the
    result: a skipped-domain link first on every 5th, an entry without link on
    every 4th and an unreachable link last on every 7th."""
    s = v_serp(spark, sf, articles)
    wid = F.col("web_id")
    entry = lambda keep, link, pos: F.struct(keep.alias("keep"), link.alias("link"), pos.alias("position"))
    entries = F.array(
        entry(wid % 5 == 0, F.concat(F.lit(SKIPPED_RESULT_URL), F.col("keyword")), F.col("position") * 10),
        entry(F.lit(True), F.col("link"), F.col("position") * 10 + 1),
        entry(wid % 4 == 0, F.lit(None).cast("string"), F.col("position") * 10 + 2),
        entry(wid % 7 == 0, F.concat(F.lit(UNREACHABLE_URL), wid.cast("string")), F.col("position") * 10 + 3),
    )
    organic = F.transform(F.filter(entries, lambda e: e["keep"]),
                          lambda e: F.struct(e["link"].alias("link"), e["position"].alias("position")))
    return s.select(
        wid.alias("response_id"), "keyword", "position",
        F.to_json(F.struct(F.struct(F.col("keyword").alias("q")).alias("searchParameters"),
                           organic.alias("organic"))).alias("response"),
    )


def v_pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages").select("page_id", "url", "html")


def v_scores(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("article_id"),
        F.when(key % 29 == 0, F.lit(0.0))
        .otherwise(F.round(F.col("o_totalprice") % 101, 2)).alias("initial"),
        F.round((F.col("o_totalprice") * 3) % 101, 2).alias("final"),
    )


def v_polls(spark: SparkSession, sf: str) -> DataFrame:
    """Score-poll observation log: one row per poll attempt."""
    e = read_table(spark, sf, "events")
    base = e.select(
        F.col("user_id").cast("string").alias("doc_id"), "ts", "event_id",
        F.when(F.col("event_type") == "purchase", "done").otherwise("pending").alias("status"),
        F.col("value").alias("content_score"),
        F.when(F.col("event_id") % 4 != 0, F.array(
            F.concat(F.lit("term "), (F.col("event_id") % 7).cast("string")),
            F.concat(F.lit("term "), (F.col("event_id") % 11 + 7).cast("string")))).alias("lsi_keywords"),
        F.when(F.col("event_id") % 3 != 0, F.array(
            F.concat(F.lit("Part "), (F.col("event_id") % 5).cast("string")))).alias("suggested_headings"),
    )
    return number_within(base, ["doc_id"], ["ts", "event_id"], "attempt")


def v_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Similarity-service matches, loosely typed strings."""
    li = read_table(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").cast("string").alias("article_id"),
        ln.alias("match_no"),
        F.when(ln % 3 == 0, F.lit(None).cast("string")).when(ln % 5 == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("string")).alias("percentmatched"),
        F.when(ln % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.round(F.col("l_tax") * 100, 2).cast("string")).alias("minper"),
        F.round(F.col("l_discount") * 100, 2).cast("string").alias("percent"),
    )


def _slug_words(text: F.Column, n: int) -> F.Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.array_join(F.slice(words, 1, n), "-")


def response_body(conv_text: F.Column, key: F.Column, keyword: F.Column) -> F.Column:
    """Generated-output JSON derived from a conversation turn and the keyword of
    the article it rewrites.  Lengths, keyword, type and keys are right in some
    of the outputs and wrong in others."""
    first_line = F.split(conv_text, "\n", -1).getItem(0)
    kw = F.coalesce(keyword, F.lit("none"))
    title = F.concat(kw, F.lit(" "), F.replace(conv_text, F.lit("\n"), F.lit(" ")))
    return F.to_json(F.struct(
        F.concat(F.lit("<h1>"), escape_text(first_line), F.lit("</h1>\n<p>"),
                 escape_text(conv_text), F.lit("</p>"),
                 F.when(key % 3 == 0, F.concat(F.lit("\n<p>See [INTERNAL LINK NEEDED: "),
                                               _slug_words(conv_text, 2), F.lit("]</p>")))
                 .otherwise(F.lit(""))).alias("optimized_html"),
        F.when(key % 3 == 0, F.left(title, F.lit(55))).when(key % 3 == 1, first_line).otherwise(title).alias("title_tag"),
        F.when(key % 4 == 1, F.left(title, F.lit(155))).when(key % 4 == 3, conv_text)
        .otherwise(F.left(conv_text, F.lit(155))).alias("meta_description"),
        F.when(key % 5 < 3, F.concat(kw, F.lit("-guide-"), key.cast("string"))).otherwise(_slug_words(conv_text, 4)).alias("slug"),
        F.when(key % 11 != 0, first_line).alias("og_title"),  # this key is missing from every eleventh output
        F.when(key % 6 == 0, conv_text).otherwise(F.left(conv_text, F.lit(180))).alias("og_description"),
        F.struct(
            F.when(key % 7 == 0, "Article").otherwise("BlogPosting").alias("@type"),
            first_line.alias("headline"),
            conv_text.alias("description"),
        ).alias("schema_markup"),
        F.create_map(F.lit("hero.jpg"), first_line, F.lit("detail.jpg"),
                     F.concat(F.lit("Photo of "), kw)).alias("alt_texts"),
        F.array(F.struct(
            F.lit("introduction").alias("location"),
            _slug_words(conv_text, 2).alias("suggested_topic"),
        )).alias("internal_link_suggestions"),
        F.concat(F.lit("Rewrote turn "), key.cast("string")).alias("changes_summary"),
    ))


def v_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Generated rewrites of articles (a conversation has at most eight turns,
    so each rewrite has an article of its own): plain JSON, fenced, unclosed
    fence, truncated."""
    key = F.col("conv_id") * 8 + F.col("turn")
    kw = v_articles(spark, sf).select("article_id", F.col("target_keyword").alias("_kw"))
    c = read_table(spark, sf, "conversations").where(F.col("role") == "assistant").withColumn(
        "article_id", key.cast("string")).join(kw, "article_id", "left")
    m = F.col("conv_id") % 4
    raw = (
        F.when(m == 0, F.col("_b"))
        .when(m == 1, F.concat(F.lit("```json\n"), F.col("_b"), F.lit("\n```")))
        .when(m == 2, F.concat(F.lit("```\n"), F.col("_b")))
        .otherwise(F.expr("substring(_b, 1, char_length(_b) - 7)"))
    )
    return c.withColumn("_b", response_body(F.col("text"), key, F.col("_kw"))).select("article_id", raw.alias("raw"))


def v_stories(spark: SparkSession, sf: str) -> DataFrame:
    """Reviewer comments on approval tasks."""
    c = read_table(spark, sf, "conversations").where(F.col("role") == "user")
    m = F.col("turn") % 4
    text = (
        F.when(m == 0, F.lit("APPROVE"))
        .when(m == 1, F.concat(F.lit("reject : "), F.col("text")))
        .when(m == 2, F.lit("REJECT"))
        .otherwise(F.col("text"))
    )
    return c.select(
        F.col("conv_id").cast("string").alias("task_gid"),
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("story_gid"),
        text.alias("text"),
    )


def v_comment_events(spark: SparkSession, sf: str, secret: str = DEFAULT_TASKS_SECRET) -> DataFrame:
    """Signed comment-event deliveries: a story event plus a task event."""
    s = v_stories(spark, sf)
    sid = F.col("story_gid").cast("bigint")
    action = F.when(sid % 5 == 4, F.lit("removed")).otherwise(F.lit("added"))
    ev_schema_story = F.struct(
        action.alias("action"),
        F.struct(F.lit("story").alias("resource_type"), F.col("story_gid").alias("gid")).alias("resource"),
        F.struct(F.col("task_gid").alias("gid")).alias("parent"),
    )
    ev_task = F.struct(
        F.lit("changed").alias("action"),
        F.struct(F.lit("task").alias("resource_type"), F.col("task_gid").alias("gid")).alias("resource"),
        F.struct(F.lit(None).cast("string").alias("gid")).alias("parent"),
    )
    payload = F.to_json(F.struct(F.array(ev_schema_story, ev_task).alias("events")))
    return s.withColumn("payload", payload).select(
        sid.alias("delivery_id"),
        "payload",
        F.when(sid % 7 == 3, F.lit(WRONG_SIGNATURE))
        .otherwise(hmac_sha256_hex(F.col("payload"), secret)).alias("signature"),
    )


# The columns of the run table.
RUN_COLUMNS = (
    ("id", "bigint"), ("article_id", "string"), ("blog_id", "string"), ("title", "string"),
    ("language", "string"), ("status", "string"), ("target_keyword_input", "string"),
    ("main_keyword", "string"), ("initial_surfer_score", "double"), ("final_surfer_score", "double"),
    ("score_delta", "double"), ("score_delta_pct", "double"), ("plagiarism_flagged", "boolean"),
    ("plagiarism_max_similarity", "double"), ("original_content", "string"),
    ("optimized_content", "string"), ("optimized_metadata", "string"), ("failure_reason", "string"),
    ("asana_task_gid", "string"), ("surfer_doc_id", "string"), ("created_at", "timestamp_ntz"),
    ("updated_at", "timestamp_ntz"), ("completed_at", "timestamp_ntz"), ("duration_seconds", "double"),
)


def v_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run table (24 columns) staged from ``orders``; columns the orders do
    not determine are NULL."""
    o = read_table(spark, sf, "orders")
    key = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    known = {
        "id": key,
        "article_id": (key * 2 + 1).cast("string"),
        "blog_id": (key % 3).cast("string"),
        "title": F.when(key % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("Article "), key.cast("string"))),
        "language": F.when(key % 4 == 0, F.lit("fr")).otherwise(F.lit("en")),
        "status": F.when(st == "F", "failed").when(st == "O", "awaiting_approval").when(st == "P", "pending"),
        "asana_task_gid": F.col("o_custkey").cast("string"),
        "created_at": F.col("o_orderdate"),
        "updated_at": F.col("o_orderdate"),
    }
    return o.select(*[(known[n] if n in known else F.lit(None)).cast(t).alias(n) for n, t in RUN_COLUMNS])


def v_run_events(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    et = F.col("event_type")
    action = (
        F.when(et == "signup", "created").when(et == "view", "started")
        .when(et == "purchase", "scored").when(et == "click", "approve")
        .when((et == "error") & (F.col("event_id") % 2 == 1), "reject")
        .when(et == "error", "failed")
    )
    return e.select(
        F.col("user_id").cast("string").alias("article_id"), "ts", "event_id",
        action.alias("action"),
        F.when(action == "reject", F.concat(F.lit("note "), F.col("event_id").cast("string"))).alias("reason"),
    )


def v_corpus(spark: SparkSession, sf: str) -> DataFrame:
    b = read_table(spark, sf, "benchmark")
    return b.select(F.col("item_id").alias("source_id"), "text")


# Our own short prompt and voice texts (not the reference's).
PROMPTS = (
    ("en", "You edit blog drafts for search. Keep facts. Voice guide:\n{brand_voice_content}",
     "Warm, plain, concrete. Avoid hype."),
    ("fr", "Vous révisez des brouillons pour la recherche. Gardez les faits. Ton :\n{brand_voice_content}",
     "Chaleureux, simple, concret. Évitez l'emphase."),
)


def v_prompts(spark: SparkSession, sf: str | None = None) -> DataFrame:
    return spark.createDataFrame(list(PROMPTS), "language string, system_prompt string, brand_voice string")


def v_metafields(spark: SparkSession, sf: str) -> DataFrame:
    """Article metafields, long form: a title tag, the target keyword (empty
    on every 13th article) and, on every 7th, a second, later keyword entry."""
    a = v_articles(spark, sf)
    doc = F.col("article_id").cast("bigint")
    rows = F.array(
        F.struct(F.lit(True).alias("keep"), F.lit(1).alias("pos"), F.lit("global").alias("namespace"),
                 F.lit("title_tag").alias("key"), F.col("title").alias("value")),
        F.struct(F.lit(True).alias("keep"), F.lit(2).alias("pos"), F.lit("seo").alias("namespace"),
                 F.lit("target_keyword").alias("key"), F.coalesce(F.col("target_keyword"), F.lit("")).alias("value")),
        F.struct((doc % 7 == 0).alias("keep"), F.lit(3).alias("pos"), F.lit("seo").alias("namespace"),
                 F.lit("target_keyword").alias("key"), F.concat(F.lit("later-"), F.col("article_id")).alias("value")),
    )
    return a.select("article_id", F.explode(F.filter(rows, lambda r: r["keep"])).alias("_m")).select(
        "article_id", F.col("_m.pos").alias("pos"), F.col("_m.namespace").alias("namespace"),
        F.col("_m.key").alias("key"), F.col("_m.value").alias("value"))


def v_doc_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring-service document-creation responses: id at the top, nested
    under ``data``, empty top id with a nested one, or none."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    resp = (
        F.when(k % 3 == 0, F.concat(F.lit('{"id": "doc-'), ks, F.lit('"}')))
        .when(k % 3 == 1, F.concat(F.lit('{"data": {"id": "nested-'), ks, F.lit('"}}')))
        .when(k % 5 == 0, F.concat(F.lit('{"id": "", "data": {"id": "nested-'), ks, F.lit('"}}')))
        .otherwise(F.lit("{}"))
    )
    return o.select(k.alias("response_id"), resp.alias("response"))
