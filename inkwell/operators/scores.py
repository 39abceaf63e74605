"""Scores and similarity results (SURVEY 2.5 A3, A5; 2.8 X3, X19, X22;
2.12 D2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.values import FLOAT_RE, strip_ws

SIMILARITY_THRESHOLD = 15.0
POLL_MAX_ATTEMPTS = 12
LOW_DELTA = 10.0

def score_delta(df: DataFrame, initial: str = "initial", final: str = "final") -> DataFrame:
    """Delta and percent change; 0.0 percent when the initial score is 0
    or missing (a missing initial score counts as 0)."""
    i = F.coalesce(F.col(initial), F.lit(0.0))
    d = F.col(final) - i
    return df.withColumn("score_delta", d).withColumn(
        "score_delta_pct", F.when(i != 0, d / i * 100).otherwise(F.lit(0.0)))


def low_delta_flag(df: DataFrame, threshold: float = LOW_DELTA) -> DataFrame:
    """A score gain under ``threshold`` points goes to manual review."""
    return df.withColumn("manual_review", F.col("score_delta") < threshold)


def _as_float(c: Column) -> Column:
    s = strip_ws(c)
    return F.when(s.rlike(FLOAT_RE), s.try_cast("double"))


def similarity_value(m: DataFrame) -> Column:
    """The first of percentmatched, minper, percent that parses as a
    number, else 0.0."""
    return F.coalesce(_as_float(F.col("percentmatched")), _as_float(F.col("minper")),
                      _as_float(F.col("percent")), F.lit(0.0))


def max_similarity_flag(articles: DataFrame, matches: DataFrame,
                        threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """A3: per article the maximum similarity of its matches; flagged when
    strictly above ``threshold``; no matches gives (false, 0.0).  The max is a
    partial (map-side) aggregate before the join."""
    best = matches.groupBy("article_id").agg(F.max(similarity_value(matches)).alias("_m"))
    return articles.join(best, "article_id", "left").select(
        *articles.columns,
        F.coalesce(F.col("_m"), F.lit(0.0)).alias("max_similarity"),
        (F.coalesce(F.col("_m"), F.lit(0.0)) > threshold).alias("plagiarism_flagged"),
    )


def poll_first_done(polls: DataFrame, max_attempts: int = POLL_MAX_ATTEMPTS) -> DataFrame:
    """A5: per document, the first observation with status ``done`` within
    ``max_attempts`` attempts, with its term and heading lists (missing ones, or
    a log without them, are empty); otherwise ``timeout``.  ``min`` over a struct
    led by the attempt is a partial aggregate: a document with a third of the
    log still costs one row per map task."""
    for c in ("lsi_keywords", "suggested_headings"):
        if c not in polls.columns:
            polls = polls.withColumn(c, F.lit(None).cast("array<string>"))
    done = (F.col("status") == "done") & (F.col("attempt") <= max_attempts)
    first = polls.groupBy("doc_id").agg(
        F.min(F.when(done, F.struct("attempt", "content_score", "lsi_keywords", "suggested_headings"))).alias("_d"))
    none = F.array().cast("array<string>")
    return first.select(
        "doc_id",
        F.when(F.col("_d").isNotNull(), F.lit("done")).otherwise(F.lit("timeout")).alias("outcome"),
        F.col("_d.attempt").alias("attempt"),
        F.when(F.col("_d").isNotNull(), F.coalesce(F.col("_d.content_score"), F.lit(0.0))).alias("content_score"),
        F.coalesce(F.col("_d.lsi_keywords"), none).alias("lsi_keywords"),
        F.coalesce(F.col("_d.suggested_headings"), none).alias("suggested_headings"),
    )


DOC_RESPONSE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StructType([T.StructField("id", T.StringType())])),
])


def document_id(responses: DataFrame, col: str = "response") -> DataFrame:
    """``id``, else ``data.id``; neither gives an error row
    (``doc_id`` null, ``error`` set)."""
    r = F.from_json(F.col(col), DOC_RESPONSE_SCHEMA)
    doc = F.coalesce(F.nullif(r["id"], F.lit("")), F.nullif(r["data"]["id"], F.lit("")))
    return responses.withColumn("doc_id", doc).withColumn(
        "error", F.when(F.col("doc_id").isNull(), F.lit("no document id in response")))
