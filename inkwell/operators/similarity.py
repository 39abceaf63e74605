"""Similarity against a reference corpus.

The outside similarity service is replaced by what its documentation says it
does: overlap with collected sources.  Each text becomes its set of 5-word
shingles; article and corpus shingle sets are equi-joined on the shingle text
and counted per (article, source).  Whole texts are used.

Scale: the shingle sets are de-duplicated per document before the join (map
side, inside the row), and the join is on 64-bit hashes of the shingles, so no
shingle text is built or shuffled.  Spark picks the join by the sides' sizes at
run time and splits skewed (very common) shingles.  ``similarity_join`` reports
every sharing pair, so a shingle that many articles and sources share costs as
much as it reports; ``best_source`` does not join it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import materialise

SHINGLE_WORDS = 5


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def shingles(tok: Column, k: int = SHINGLE_WORDS) -> Column:
    """Distinct k-word shingles of a token array column, as 64-bit hashes of
    their words (``array<bigint>``): no shingle text is ever built.

    ``tok`` must be a materialised column (see ``with_shingles``): an inline
    expression would be re-evaluated inside the lambda, once per shingle."""
    n = F.size(tok)
    return F.when(n >= k, F.array_distinct(F.transform(
        F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(tok, i + j) for j in range(k)])
    ))).otherwise(F.array().cast("array<bigint>"))


def with_shingles(df: DataFrame, text: str, out: str = "_s", k: int = SHINGLE_WORDS) -> DataFrame:
    """Add the distinct shingles of ``text``: tokens first, in their own
    projection, so that the regular expression runs once per row."""
    return df.withColumn("_tok", tokens(F.col(text))).withColumn(out, shingles(F.col("_tok"), k)).drop("_tok")


def _exploded(df: DataFrame, key: str, text: str, k: int, *more: Column) -> DataFrame:
    """(key, shingle) rows.  explode_outer + a filter after it: plain explode
    makes the optimizer infer ``size(_s) > 0`` and push it (with the whole
    shingle expression) below the projection that computes the shingles once."""
    return with_shingles(df.select(key, text), text, "_s", k).select(
        key, *more, F.explode_outer("_s").alias("shingle")).where(F.col("shingle").isNotNull())


def similarity_join(articles: DataFrame, corpus: DataFrame, text: str = "text",
                    k: int = SHINGLE_WORDS) -> DataFrame:
    """Per (article, source) sharing at least one shingle: shared
    shingles, the article's shingles and ``similarity`` = shared / article
    shingles x 100."""
    a = _exploded(articles, "article_id", text, k, F.size("_s").alias("article_shingles"))
    c = _exploded(corpus, "source_id", text, k)
    pairs = a.join(c, "shingle").groupBy("article_id", "source_id", "article_shingles").agg(
        F.count(F.lit(1)).cast("int").alias("shared"))
    return pairs.select("article_id", "source_id", "shared", F.col("article_shingles").cast("int"),
                        (F.col("shared") * 100.0 / F.col("article_shingles")).alias("similarity"))


def _shingle_classes(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shingles that occur in exactly the same sources are one class.  Returns
    (shingle, k1, k2, df, first) and the postings (k1, k2, source_id); a class is
    named by two hashes over its sources, ``first`` is the least of them."""
    of = corpus.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("df"), F.min("source_id").alias("first"),
        F.bit_xor(F.xxhash64("source_id")).alias("k1"), F.bit_xor(F.xxhash64("source_id", F.lit(1))).alias("k2"))
    # one shingle stands for its class: only its postings are kept
    chosen = of.groupBy("k1", "k2").agg(F.min("shingle").alias("shingle"))
    return of, chosen.join(corpus, "shingle").select("k1", "k2", "source_id")


def best_source(articles: DataFrame, corpus: DataFrame, text: str = "text", k: int = SHINGLE_WORDS,
                rarest: int = 16) -> DataFrame:
    """J9, best source only: per article the source that shares most shingles
    (of equals the least id), exactly, without joining common shingles.

    An article's shingles are joined from the rarest on (frequency-ordered
    prefix).  A round joins the classes of at most ``rarest`` sources (16 times
    as many in the next round); its candidates are counted in full; a source
    that shares none of them can reach no more than the weight of the classes
    not joined yet (the positional bound).  An article is finished when its best
    candidate is above that bound, or when a single class is left: then the
    unseen sources all share exactly that class and the least of them stands for
    all.  So a passage that a million sources hold is joined only for articles
    whose best source cannot be told without it."""
    sets = materialise(with_shingles(articles.select("article_id", text), text, "_s", k).select(
        "article_id", F.size("_s").alias("article_shingles"), "_s"), "article-shingles")
    of, postings = _shingle_classes(materialise(_exploded(corpus, "source_id", text, k).distinct(), "corpus-shingles"))
    postings = materialise(postings, "postings")
    known = materialise(sets.select("article_id", F.explode("_s").alias("shingle")).join(of, "shingle")
                        .groupBy("article_id", "k1", "k2", "df", "first").agg(F.count(F.lit(1)).alias("w")), "article-classes")
    active, found = known, None
    while True:
        rare = F.col("df") <= rarest
        open_ = active.groupBy("article_id").agg(
            F.sum(F.when(~rare, F.col("w")).otherwise(0)).alias("unseen"), F.count(F.when(~rare, 1)).alias("classes"),
            F.max(F.when(~rare, F.struct("w", "first"))).alias("last"))
        part = active.where(rare).join(postings, ["k1", "k2"]).groupBy("article_id", "source_id").agg(F.sum("w").alias("part"))
        rest = active.where(~rare).join(part.select("article_id", "source_id"), "article_id") \
            .join(postings, ["k1", "k2", "source_id"]).groupBy("article_id", "source_id").agg(F.sum("w").alias("more"))
        counted = part.join(rest, ["article_id", "source_id"], "left").select(
            "article_id", "source_id", (F.col("part") + F.coalesce("more", F.lit(0))).alias("shared"))
        alone = open_.where("classes = 1").select("article_id", F.col("last.first").alias("source_id"), F.col("last.w").alias("shared"))
        # of two rows of one source the fuller count wins
        best = counted.unionByName(alone).groupBy("article_id").agg(F.max_by(
            F.struct("source_id", "shared"), F.struct("shared", -F.col("source_id"))).alias("b"))
        state = materialise(open_.join(best, "article_id", "left").select("article_id", "b", (
            (F.col("classes") <= 1) | F.coalesce(F.col("b.shared") > F.col("unseen"), F.lit(False))).alias("done")), "best-source")
        done = state.where("done").select("article_id", "b.source_id", "b.shared")
        found = done if found is None else found.unionByName(done)
        open_rows = state.where("not done").select("article_id")
        if open_rows.isEmpty():
            break
        active, rarest = materialise(active.join(open_rows, "article_id", "left_semi"), "article-classes"), rarest * 16
    return sets.select("article_id", "article_shingles").join(found, "article_id", "left").select(
        "article_id", "source_id", F.coalesce("shared", F.lit(0)).cast("int").alias("shared"),
        F.col("article_shingles").cast("int"),
        F.when(F.col("shared") > 0, F.col("shared") * 100.0 / F.col("article_shingles")).otherwise(0.0).alias("similarity"))


def similarity_flag(best: DataFrame, threshold: float = 15.0) -> DataFrame:
    """A3 over J9: the similarity of the best source per article and the flag
    (strictly above ``threshold``); an article without any shared shingle gets
    (false, 0.0)."""
    return best.select("article_id", F.col("similarity").alias("max_similarity"),
                       (F.col("similarity") > threshold).alias("plagiarism_flagged"))
