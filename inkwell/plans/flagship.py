"""Flagship: the per-article enrichment record -- draft
articles joined with everything the pipeline derives for them: language
route, missing-keyword outcome, heading repair and its HTML, secondary
keywords, competitor structure for their keyword, content score and the
similarity flag against the reference corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import html as H
from inkwell.functions.language import detect_language, learn_profiles, route_language
from inkwell.operators import competitors as C
from inkwell.operators import events as E
from inkwell.operators import headings as HD
from inkwell.operators import keywords as K
from inkwell.operators import scores as S
from inkwell.operators import similarity as SIM
from inkwell.session import materialise
from inkwell.sources import views as V
from inkwell.sources.tables import read_table


def enrichment_star(spark: SparkSession, sf: str) -> DataFrame:
    profiles = learn_profiles(read_table(spark, sf, "documents"))
    # everything that comes from the article alone is one projection of it
    articles = materialise(V.v_articles(spark, sf), "articles")
    a = HD.normalize_html_structure(articles).withColumn("_text", H.html_to_text("body_html"))
    a = materialise(a.select(
        "article_id", "target_keyword", F.col("_text").alias("text"), *HD.skip_columns(),
        F.col("target_keyword").alias("seed"),
        route_language(detect_language(F.col("_text"), profiles)).alias("language"),
        F.md5(F.col("normalized_html").cast("binary")).alias("normalized_md5")), "enrichment")
    base = E.missing_keyword_split(a)
    kws = a.select(F.col("target_keyword").alias("keyword")).where(F.col("keyword").isNotNull())
    top = C.competitor_links(C.search_results_scan(V.v_serp_responses(spark, sf, articles)))
    struct = C.competitor_structure(kws, top, C.fetch_competitors(top, V.v_web(spark, sf, articles)))
    sim = SIM.similarity_flag(SIM.best_source(a.select("article_id", "text"), V.v_corpus(spark, sf)))
    secondary = K.secondary_keywords(K.related_keywords_parse(V.v_topic_reports(spark, sf))).groupBy("seed").agg(
        F.array_sort(F.collect_list(F.struct("rank", "keyword"))).alias("_k"))  # at most five a seed
    score = S.poll_first_done(V.v_polls(spark, sf)).select(F.col("doc_id").alias("article_id"), "content_score")
    return (
        base.join(sim, "article_id").join(score, "article_id", "left").join(secondary, "seed", "left")
        .join(struct, base["target_keyword"] == struct["keyword"], "left")
        .select(
            "article_id", "language", "target_keyword", "outcome", "headings", "corrected", "normalized_md5",
            F.array_join(F.coalesce(F.col("_k.keyword"), F.array().cast("array<string>")), " | ").alias("secondary_keywords"),
            F.coalesce(F.col("structure_source"), F.lit("none")).alias("structure_source"),
            F.array_join(F.coalesce(F.col("h2_topics"), F.array().cast("array<string>")), " | ").alias("h2_topics"),
            "content_score", "max_similarity", "plagiarism_flagged",
        )
    )


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment_star(spark, sf)
