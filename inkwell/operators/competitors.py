"""Competitor research (SURVEY 2.1 S7, 2.3 F7, 2.5 A1, A2, A4, 2.6 W7,
2.7 U1, 2.8 X5-X8, X20).

Search responses and fetched pages are staged tables; "fetching" a result is
an equi-join of its link with the crawled documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.html import (
    hide_raw,
    html_to_text,
    plain_word_count,
    strip_boilerplate,
    tag_texts,
    word_count,
)
from inkwell.session import materialise

# Result hosts that are never used as competitors (substring
# match on the host, case-sensitive).
SKIP_DOMAINS = ("wikipedia.org", "reddit.com", "quora.com", "amazon.com", "youtube.com")
RESULTS_REQUESTED = 7  # 5 wanted + 2 spare, as sent to the search service
COMPETITORS_KEPT = 3
H2_TOPICS_KEPT = 8

# The structure used when no competitor page could be used.
FALLBACK_TOPIC_TEMPLATES = ("What is {kw}", "Benefits of {kw}", "How to choose {kw}", "Tips for {kw}")
FALLBACK_WORD_COUNT = 1200
FALLBACK_H2_COUNT = 5

_RESPONSE_SCHEMA = T.StructType([
    T.StructField("organic", T.ArrayType(T.StructType([
        T.StructField("link", T.StringType()),
        T.StructField("position", T.IntegerType()),
    ]))),
])


def search_results_scan(responses: DataFrame) -> DataFrame:
    """``(response_id, keyword, position, response)`` -> one row per
    organic entry in response order; a missing link becomes ``""``."""
    parsed = responses.select(
        "response_id", "keyword", "position",
        F.from_json("response", _RESPONSE_SCHEMA)["organic"].alias("_o"),
    )
    return parsed.select(
        "response_id", "keyword", "position",
        F.posexplode("_o").alias("entry", "_e"),
    ).select(
        "response_id", "keyword", "position", F.col("entry").cast("int").alias("entry"),
        F.coalesce(F.col("_e.link"), F.lit("")).alias("link"),
    )


def link_host(link: F.Column | str = "link") -> F.Column:
    """Third ``/``-piece of links starting with ``http``; ``""`` otherwise;
    null for a malformed ``http`` link with fewer than three pieces."""
    c = F.col(link) if isinstance(link, str) else link
    return F.when(c.startswith("http"), F.try_element_at(F.split(c, "/"), F.lit(3))).otherwise(F.lit(""))


def domain_skip_filter(results: DataFrame, skip: tuple[str, ...] = SKIP_DOMAINS) -> DataFrame:
    """drop empty links, malformed ``http`` links and links whose host
    contains any skipped name."""
    host = link_host("link")
    skipped = F.exists(F.array(*[F.lit(s) for s in skip]), lambda s: F.contains(host, s))
    return results.where((F.col("link") != "") & host.isNotNull() & ~skipped)


def competitor_top(results: DataFrame, requested: int = RESULTS_REQUESTED,
                   kept: int = COMPETITORS_KEPT, skip: tuple[str, ...] = SKIP_DOMAINS) -> DataFrame:
    """Of the first ``requested`` entries per keyword (search order), the
    first ``kept`` that survive F7.  Both steps are ``row_number() <= k``, which
    Spark cuts map-side (partial WindowGroupLimit), so a hot keyword costs
    ``k`` rows per map task, not its full size."""
    order = Window.partitionBy("keyword").orderBy("position", "entry")
    first = results.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= requested)
    kept_rows = domain_skip_filter(first, skip).withColumn("rank", F.row_number().over(
        Window.partitionBy("keyword").orderBy("_r")))
    return kept_rows.where(F.col("rank") <= kept).select(
        "keyword", F.col("rank").cast("int").alias("rank"), "link")


def competitor_links(results: DataFrame) -> DataFrame:
    """:func:`competitor_top`, staged: every branch of a plan that fetches the
    links would parse and rank the search responses again."""
    return materialise(competitor_top(results), "competitor-links")


def page_structure(pages: DataFrame, html: str = "html") -> DataFrame:
    """A4 + X5-X8: per page, after removing boilerplate elements: text of the
    first H1 (``""`` if none), H2 and H3 texts, and the word count."""
    return pages.withColumn("_clean", strip_boilerplate(F.col(html))).withColumn("_hidden", hide_raw("_clean")).select(
        *[c for c in pages.columns if c != html],
        F.coalesce(F.try_element_at(tag_texts("_hidden", "h1", hidden=True), F.lit(1)), F.lit("")).alias("h1"),
        tag_texts("_hidden", "h2", hidden=True).alias("h2s"),
        tag_texts("_hidden", "h3", hidden=True).alias("h3s"),
        word_count(html_to_text("_clean")).alias("word_count"),
    )


def page_heading_counts(pages: DataFrame) -> DataFrame:
    """A4: h1 text, number of H2 and H3, word count per page."""
    s = page_structure(pages)
    return s.select(
        "page_id", "url", "h1",
        F.size("h2s").cast("int").alias("h2_count"),
        F.size("h3s").cast("int").alias("h3_count"),
        "word_count",
    )


def fetch_competitors(top: DataFrame, web: DataFrame) -> DataFrame:
    """Fetch = equi-join of each kept link with the crawled documents; a link
    with no document is a failed fetch and is dropped.  Duplicate URLs resolve
    to the lowest ``web_id``, which is found on ids alone; each kept page is
    parsed once, and after that only what was measured is joined."""
    kept = top.select("link").distinct()
    first = web.select(F.col("url").alias("link"), "web_id").join(kept, "link", "left_semi").groupBy("link").agg(
        F.min("web_id").alias("web_id"))
    pages = page_structure(web.select("web_id", "html").join(first.select("web_id"), "web_id", "left_semi"))
    return top.join(first, "link").join(pages, "web_id")


def competitor_texts(top: DataFrame, web: DataFrame) -> DataFrame:
    """(keyword, web_id, text, word_count) of the pages behind the kept links,
    without their boilerplate elements."""
    top = materialise(top, "competitor-links")
    kept = top.select("link").distinct()
    first = web.select(F.col("url").alias("link"), "web_id").join(kept, "link", "left_semi").groupBy("link").agg(
        F.min("web_id").alias("web_id"))
    pages = web.select("web_id", "html").join(first.select("web_id"), "web_id", "left_semi").select(
        "web_id", html_to_text(strip_boilerplate("html")).alias("text"))
    return top.select("keyword", "link").join(first, "link").join(pages, "web_id").select(
        "keyword", "web_id", "text", plain_word_count("text").alias("word_count"))


def heading_union(fetched: DataFrame) -> DataFrame:
    """All H2s of the fetched pages of a keyword, page order then document
    order, duplicates kept."""
    return fetched.select(
        "keyword", F.col("rank").alias("page_rank"), F.posexplode_outer("h2s").alias("h2_pos", "h2")
    ).where(F.col("h2").isNotNull()).select("keyword", "page_rank", (F.col("h2_pos") + 1).cast("int").alias("h2_pos"), "h2")


def h2_topics(union: DataFrame, kept: int = H2_TOPICS_KEPT) -> DataFrame:
    """A1: first spelling of each case-insensitively distinct H2, in
    first-seen order, first ``kept`` per keyword."""
    first = union.groupBy("keyword", F.lower("h2").alias("_k")).agg(
        F.min(F.struct("page_rank", "h2_pos", "h2")).alias("_f"))
    w = Window.partitionBy("keyword").orderBy(F.col("_f.page_rank"), F.col("_f.h2_pos"))
    return first.withColumn("topic_rank", F.row_number().over(w)).where(
        F.col("topic_rank") <= kept
    ).select("keyword", F.col("topic_rank").cast("int").alias("topic_rank"), F.col("_f.h2").alias("h2"))


def structure_averages(fetched: DataFrame) -> DataFrame:
    """A2: integer-truncated mean word count and H2 count of fetched pages."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return fetched.groupBy("keyword").agg(
        (F.sum("word_count") / n).cast("int").alias("avg_word_count"),
        (F.sum(F.size("h2s")) / n).cast("int").alias("avg_h2_count"),
        F.count(F.lit(1)).cast("int").alias("pages_used"),
    )


def _fallback_topics(kw: F.Column) -> F.Column:
    parts = []
    for t in FALLBACK_TOPIC_TEMPLATES:
        pre, post = t.split("{kw}")
        parts.append(F.concat(F.lit(pre), kw, F.lit(post)))
    return F.array(*parts)


def competitor_structure(keywords: DataFrame, top: DataFrame, fetched: DataFrame) -> DataFrame:
    """X20 + A1 + A2 per searched keyword: the competitor URLs used and the
    dominant structure; the template when no page could be used.  ``top`` is read
    more than once: :func:`competitor_links`.  Every list here is bounded (3 URLs,
    8 topics), so the ordered collects are small."""
    fetched = materialise(fetched, "competitor-pages")
    urls_found = top.groupBy("keyword").agg(
        F.array_sort(F.collect_list(F.struct("rank", "link"))).alias("_u"))
    urls_used = fetched.groupBy("keyword").agg(
        F.array_sort(F.collect_list(F.struct("rank", "link"))).alias("_p"))
    topics = h2_topics(heading_union(fetched)).groupBy("keyword").agg(
        F.array_sort(F.collect_list(F.struct("topic_rank", "h2"))).alias("_t"))
    avgs = structure_averages(fetched)
    k = (keywords.select("keyword").distinct()
         .join(urls_found, "keyword", "left").join(urls_used, "keyword", "left")
         .join(topics, "keyword", "left").join(avgs, "keyword", "left"))
    has_pages = F.col("_p").isNotNull()
    return k.select(
        "keyword",
        F.when(has_pages, F.col("_p.link")).when(F.col("_u").isNotNull(), F.col("_u.link"))
        .otherwise(F.array().cast("array<string>")).alias("competitor_urls"),
        F.when(has_pages, F.coalesce(F.col("_t.h2"), F.array().cast("array<string>")))
        .otherwise(_fallback_topics(F.col("keyword"))).alias("h2_topics"),
        F.when(has_pages, F.col("avg_word_count")).otherwise(F.lit(FALLBACK_WORD_COUNT)).alias("avg_word_count"),
        F.when(has_pages, F.col("avg_h2_count")).otherwise(F.lit(FALLBACK_H2_COUNT)).alias("avg_h2_count"),
        F.when(has_pages, F.lit("competitors")).otherwise(F.lit("template")).alias("structure_source"),
    )
