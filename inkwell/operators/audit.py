"""Content-rule audit: the rules the reference only
states as instructions, measured per article.  One row per article with the
measure and a boolean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.html import html_to_text, plain_word_count, tag_texts
from inkwell.session import materialise

DENSITY_MIN, DENSITY_MAX = 1.0, 2.0
FIRST_WORDS = 100
# The keys of a generated output.
OUTPUT_KEYS = ("optimized_html", "title_tag", "meta_description", "slug", "og_title", "og_description",
               "schema_markup", "alt_texts", "internal_link_suggestions", "changes_summary")
# Our own voice lists (phrases to avoid / to use), per language.
VOICE = {
    "en": (("it was", "there is", "to be", "very"), ("this is", "with the", "for the", "your")),
    "fr": (("il est", "dans la", "très"), ("avec le", "pour les", "votre")),
}


def _kw() -> Column:
    return F.lower(F.col("target_keyword"))


def audit_h1(plan: DataFrame) -> DataFrame:
    """Q1: exactly one H1 (as written) and it contains the keyword."""
    # without an H1 as written, raw_levels holds no 1, so the texts' shift by
    # an inserted title never matters here
    h1s = F.filter(F.arrays_zip(F.col("raw_levels").alias("l"), F.col("fixed_texts").alias("t")),
                   lambda z: z["l"] == 1)
    first = F.lower(F.try_element_at(h1s, F.lit(1))["t"])
    has = F.coalesce(F.contains(first, _kw()), F.lit(False))
    return plan.select("article_id", F.size(h1s).cast("int").alias("h1_count"), has.alias("h1_has_keyword"),
                       ((F.size(h1s) == 1) & has).alias("ok"))


def audit_keyword_first_100(articles: DataFrame) -> DataFrame:
    """Q2: the keyword within the first 100 words of the plain text."""
    words = F.filter(F.split(F.lower(html_to_text("body_html")), r"(?U)\s+"), lambda w: w != "")
    head = F.array_join(F.slice(words, 1, FIRST_WORDS), " ")
    return articles.select("article_id", F.coalesce(F.contains(head, _kw()), F.lit(False)).alias("ok"))


def question_matches(headings: DataFrame, questions: DataFrame) -> DataFrame:
    """H2s based on a question keyword of the article's keyword: the same words
    (case and punctuation aside), or all of the question's words among the
    heading's.  ``headings``: article_id, keyword, seq, text; ``questions``:
    keyword, question.  Returns article_id, seq, question, equal.

    A question is looked up by its rarest word (in all headings) only, so a word
    that every heading has joins nothing unless a question has no other.  What is
    shuffled a word is a heading's number and a hash of keyword and word; the
    headings that are found join their text again and are compared."""
    cut = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), 0)
    words = lambda c: F.array_distinct(cut(c))
    h = materialise(headings.select("article_id", "keyword", "seq", "text", F.monotonically_increasing_id().alias("_row")), "headings")
    q = questions.select("keyword", "question").distinct().select("*", words(F.col("question")).alias("_q"))
    common = h.select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = q.select("keyword", "question", "_q", F.explode("_q").alias("word")).join(common, "word", "left") \
        .groupBy("keyword", "question").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("_r"),
                                            F.first("_q").alias("_q")) \
        .where("_r.n > 0 and keyword is not null").select(
            F.col("keyword").alias("_kw"), "question", "_q", F.xxhash64("keyword", "_r.word").alias("_at"))
    places = h.where("keyword is not null").select("_row", "keyword", F.explode(words(F.col("text"))).alias("word")).select(
        "_row", F.xxhash64("keyword", "word").alias("_at"))
    found = places.join(rarest, "_at").drop("_at").join(h, "_row").where("keyword = _kw")
    return found.where(F.size(F.array_except("_q", words(F.col("text")))) == 0).select(
        "article_id", "seq", "question", (cut(F.col("text")) == cut(F.col("question"))).alias("equal"))


def audit_question_h2(articles: DataFrame, questions: DataFrame) -> DataFrame:
    """Q5: at least one H2 based on a question keyword of the article's keyword;
    also the H2s that are written as a question (end with '?')."""
    h = materialise(articles.select("article_id", F.col("target_keyword").alias("keyword"), tag_texts("body_html", "h2").alias("_h")),
                    "h2-texts")
    rows = h.select("article_id", "keyword", F.posexplode("_h").alias("seq", "text"))
    hits = question_matches(rows, questions).groupBy("article_id").agg(F.countDistinct("seq").alias("_n"))
    n = F.coalesce(F.col("_n"), F.lit(0))
    return h.join(hits, "article_id", "left").select(
        "article_id", F.size(F.filter("_h", lambda t: t.endswith("?"))).alias("question_h2s"),
        n.cast("int").alias("matched_h2s"), (n > 0).alias("ok"))


def audit_keyword_density(articles: DataFrame) -> DataFrame:
    """Q6: whole-phrase keyword occurrences per 100 words, within 1-2."""
    d = articles.withColumn("_t", F.lower(html_to_text("body_html"))).withColumn("_kw", _kw())
    words = plain_word_count(F.col("_t"))
    phrase = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace("_kw", F.lit("\\E"), F.lit("\\E\\\\E\\Q")),
                      F.lit(r"\E(?![\p{L}\p{N}])"))
    occ = F.when(F.length("_kw") > 0, F.regexp_count("_t", phrase)).otherwise(0)
    dens = F.when(words > 0, occ * 100.0 / words).otherwise(0.0)
    return d.select("article_id", occ.alias("occurrences"), words.cast("int").alias("words"),
                    dens.alias("density"), ((dens >= DENSITY_MIN) & (dens <= DENSITY_MAX)).alias("ok"))


def phrase_occurrences(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole-word occurrences of many phrases in many texts.  ``texts``: text_id,
    words (array); ``wanted``: text_id, phrase, words (array, not empty).  Returns
    text_id, phrase, occurrences for the phrases that occur.

    A positional word index is joined on (text, first word of the phrase); the
    words after it are verified by joining (text, position, word), so a text is
    cut into words once however many phrases it is asked for.  Both joins are
    equi-joins with a text in their key and split where they are skewed."""
    index = materialise(texts.select("text_id", F.posexplode("words").alias("pos", "word")), "word-index")
    found = index.join(wanted.select("text_id", "phrase", F.col("words").alias("_p"), F.get("words", F.lit(0)).alias("word")),
                       ["text_id", "word"])
    single = found.where(F.size("_p") == 1).select("text_id", "phrase", F.col("pos").alias("start"))
    tail = found.where(F.size("_p") > 1).select(
        "text_id", "phrase", F.col("pos").alias("start"), (F.size("_p") - 1).alias("_n"), F.posexplode(F.slice("_p", 2, 1 << 30)).alias("_k", "word"))
    longer = tail.withColumn("pos", F.col("start") + F.col("_k") + 1).join(index, ["text_id", "pos", "word"]).groupBy(
        "text_id", "phrase", "start", "_n").agg(F.count(F.lit(1)).alias("_c")).where("_c = _n").select("text_id", "phrase", "start")
    return single.unionByName(longer).groupBy("text_id", "phrase").agg(F.count(F.lit(1)).cast("int").alias("occurrences"))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def competitor_density(pages: DataFrame, phrases: DataFrame) -> DataFrame:
    """Q6 over competitors: per (keyword, phrase) the pages of the keyword, the
    occurrences of the phrase on them and its mean density (occurrences per 100
    words; a page without words counts as 0).  ``pages``: keyword, web_id, text,
    word_count; ``phrases``: keyword, phrase."""
    pages = materialise(pages.select("keyword", "web_id", "text", "word_count"), "density-pages")
    texts = pages.select(F.col("web_id").alias("text_id"), "text").dropDuplicates(["text_id"]).select(
        "text_id", _tokens(F.col("text")).alias("words"))
    asked = phrases.select("keyword", "phrase").distinct()
    wanted = pages.select("keyword", F.col("web_id").alias("text_id")).join(asked, "keyword").select("text_id", "phrase").distinct()
    found = phrase_occurrences(texts, wanted.withColumn("words", _tokens(F.col("phrase"))).where(F.size("words") > 0))
    per_page = asked.join(pages.select("keyword", F.col("web_id").alias("text_id"), "word_count"), "keyword").join(
        found, ["text_id", "phrase"], "left").withColumn("n", F.coalesce("occurrences", F.lit(0)))
    return per_page.groupBy("keyword", "phrase").agg(
        F.count(F.lit(1)).cast("int").alias("pages"), F.sum("n").cast("long").alias("occurrences"),
        F.avg(F.when(F.col("word_count") > 0, F.col("n") * 100.0 / F.col("word_count")).otherwise(0.0)).alias("density"))


def audit_competitor_density(articles: DataFrame, competitors: DataFrame) -> DataFrame:
    """Q6: the keyword's density in the article beside its mean density on the
    competitor pages (none without pages), and whether the article uses it more."""
    own = audit_keyword_density(articles).select("article_id", "density")
    c = competitors.select(F.col("keyword").alias("target_keyword"), F.col("density").alias("competitor_density"), "pages")
    return own.join(articles.select("article_id", "target_keyword"), "article_id").join(c, "target_keyword", "left").select(
        "article_id", "density", "competitor_density", F.coalesce("pages", F.lit(0)).alias("pages"),
        F.coalesce(F.col("density") > F.col("competitor_density"), F.lit(False)).alias("above"))


def audit_topic_copy(articles: DataFrame, topics: DataFrame) -> DataFrame:
    """Q4: article H2s equal (case-insensitively) to a competitor topic of the
    article's keyword; 0 expected.  Equi-join on (keyword, lower text)."""
    t = topics.select("keyword", F.lower("h2").alias("_k")).distinct()
    a = articles.select("article_id", F.col("target_keyword").alias("keyword"),
                        F.explode_outer(tag_texts("body_html", "h2")).alias("_h")).where(
        F.col("_h").isNotNull()).select("article_id", "keyword", F.lower("_h").alias("_k"))
    hits = a.join(t, ["keyword", "_k"]).groupBy("article_id").agg(F.count(F.lit(1)).alias("_n"))
    base = articles.select("article_id")
    return base.join(hits, "article_id", "left").select(
        "article_id", F.coalesce("_n", F.lit(0)).cast("int").alias("copied"),
        (F.coalesce("_n", F.lit(0)) == 0).alias("ok"))


def audit_output_keys(parsed: DataFrame) -> DataFrame:
    """Q9: exactly the ten keys; schema markup typed BlogPosting with headline
    and description."""
    keys = F.json_object_keys(F.col("extracted"))
    expected = F.array(*[F.lit(k) for k in OUTPUT_KEYS])
    exact = (F.size(F.array_except(keys, expected)) == 0) & (F.size(F.array_except(expected, keys)) == 0)
    sm = F.col("schema_markup")
    schema_ok = (F.get_json_object(sm, "$['@type']") == "BlogPosting") & \
        F.get_json_object(sm, "$.headline").isNotNull() & F.get_json_object(sm, "$.description").isNotNull()
    v = parsed.where(F.col("valid"))
    return v.select("article_id", F.coalesce(exact, F.lit(False)).alias("keys_ok"),
                    F.coalesce(schema_ok, F.lit(False)).alias("schema_ok"))


def alt_text_rows(parsed: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Q9: one row per image of a valid rewrite: its alt text and whether it has
    the keyword (any case)."""
    return parsed.where(F.col("valid")).select(
        "article_id", F.col(keyword).alias("_kw"), F.explode("alt_texts").alias("image", "alt_text")).select(
        "article_id", "image", "alt_text",
        F.coalesce(F.contains(F.lower("alt_text"), F.lower("_kw")), F.lit(False)).alias("has_keyword"))


def _phrase_count(text: Column, phrase: str) -> Column:
    """Occurrences of a phrase in words joined by two spaces, with one space at
    either end (so that neighbours do not share a space)."""
    found = " " + "  ".join(phrase.split()) + " "
    return ((F.length(text) - F.length(F.replace(text, F.lit(found), F.lit("")))) / len(found)).cast("int")


def audit_voice_phrases(articles: DataFrame, language: str = "language") -> DataFrame:
    """Q10: phrases to avoid / to use, of one word or more, counted over the
    plain text per language."""
    toks = F.regexp_extract_all(F.lower(html_to_text("body_html")), F.lit(r"[\p{L}\p{N}]+"), 0)
    words = F.concat(F.lit(" "), F.array_join(toks, "  "), F.lit(" "))

    def count(text: Column, side: int) -> Column:
        out = F
        for lang, lists in VOICE.items():
            out = out.when(F.col(language) == lang, sum(
                (_phrase_count(text, p) for p in lists[side][1:]), _phrase_count(text, lists[side][0])))
        return out.otherwise(0).cast("int")

    # the words are bound as a lambda variable, so they are found once
    counts = F.transform(F.array(words), lambda w: F.struct(
        count(w, 0).alias("avoid_count"), count(w, 1).alias("use_count")))[0]
    return articles.select("article_id", counts.alias("_c")).select("article_id", "_c.avoid_count", "_c.use_count")


def audit_sections(plan: DataFrame) -> DataFrame:
    """Q12: introduction and conclusion both marked."""
    return plan.select("article_id", (F.col("intro_start") > 0).alias("intro"),
                       (F.col("conclusion_at") > 0).alias("conclusion"),
                       ((F.col("intro_start") > 0) & (F.col("conclusion_at") > 0)).alias("ok"))


LINK_MARKER_RE = r"\[INTERNAL LINK NEEDED:\s*([^\]]*)\]"


def internal_link_markers(parsed: DataFrame) -> DataFrame:
    """Q11: the topics of ``[INTERNAL LINK NEEDED: topic]`` markers in the
    rewritten HTML, one row per marker in document order."""
    topics = F.regexp_extract_all(F.col("optimized_html"), F.lit(LINK_MARKER_RE), 1)
    return parsed.where(F.col("valid")).select(
        "article_id", F.posexplode_outer(topics).alias("marker_no", "topic")
    ).where(F.col("topic").isNotNull()).select(
        "article_id", (F.col("marker_no") + 1).cast("int").alias("marker_no"),
        F.trim(F.col("topic")).alias("topic"))


# Our own slug stop words (EN/FR articles, conjunctions, prepositions).
SLUG_STOP_WORDS = ("a", "an", "the", "and", "or", "of", "to", "in", "for",
                   "le", "la", "les", "de", "des", "du", "et", "un", "une")
SLUG_RE = r"^[\p{Ll}\p{N}]+(-[\p{Ll}\p{N}]+){2,4}$"


def audit_metadata(parsed: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Q8: title tag 50-60 chars starting with the keyword; meta description
    150-160 chars containing it; slug of 3-5 lower-case kebab words containing
    it, without stop words; OG description 150-200 chars, not the meta text."""
    kw = F.lower(F.col(keyword))
    t, m, sl, og = F.col("title_tag"), F.col("meta_description"), F.col("slug"), F.col("og_description")
    title_ok = F.char_length(t).between(50, 60) & F.startswith(F.lower(t), kw)
    meta_ok = F.char_length(m).between(150, 160) & F.contains(F.lower(m), kw)
    stop = F.array(*[F.lit(w) for w in SLUG_STOP_WORDS])
    slug_ok = sl.rlike(SLUG_RE) & F.contains(sl, F.replace(kw, F.lit(" "), F.lit("-"))) & ~F.arrays_overlap(F.split(sl, "-"), stop)
    og_ok = F.char_length(og).between(150, 200) & (og != m)
    cols = [F.coalesce(c, F.lit(False)).alias(n) for c, n in
            ((title_ok, "title_ok"), (meta_ok, "meta_ok"), (slug_ok, "slug_ok"), (og_ok, "og_ok"))]
    out = parsed.where(F.col("valid")).select("article_id", *cols)
    return out.withColumn("ok", F.col("title_ok") & F.col("meta_ok") & F.col("slug_ok") & F.col("og_ok"))


SECONDARY_MIN_HEADINGS = 2


def audit_secondary_headings(headings: DataFrame, secondary: DataFrame) -> DataFrame:
    """Q7: at least two H2/H3 headings contain (case-insensitively) one of the
    article's secondary keywords.  ``headings``: article_id, seed, seq, level,
    heading_text; ``secondary``: seed, keyword (at most 5 per seed, so the
    join fans out by at most 5)."""
    h = headings.where(F.col("level").isin(2, 3))
    hits = h.join(secondary.select("seed", F.lower("keyword").alias("_kw")), "seed").where(
        F.contains(F.lower(F.col("heading_text")), F.col("_kw"))
    ).groupBy("article_id").agg(F.countDistinct("seq").alias("_n"))
    base = headings.select("article_id").distinct()
    n = F.coalesce(F.col("_n"), F.lit(0))
    return base.join(hits, "article_id", "left").select(
        "article_id", n.cast("int").alias("headings_with_secondary"),
        (n >= SECONDARY_MIN_HEADINGS).alias("ok"))
