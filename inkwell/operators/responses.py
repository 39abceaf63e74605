"""Generated rewrites: extraction, validation, fields, prompts and the
write-back rows (SURVEY 2.2 K2, K3; 2.4 J7; 2.8 X10-X12, X14, X23, X24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.values import strip_ws

FENCE = "```"
CORRECTION_CHARS = 2000
# Our own correction prompt (the reference's text is not reused).
CORRECTION_PROMPT = ("Your previous reply was not valid JSON. Reply again with only the JSON object, "
                     "nothing before or after it.\n\nPrevious reply:\n%s")
INVALID_REASON = "Text generation failed to produce valid JSON after retry."

LINKS_TYPE = T.ArrayType(T.StructType([T.StructField("location", T.StringType()),
                                       T.StructField("suggested_topic", T.StringType())]))
# The fields of a generated output.
OUTPUT_SCHEMA = T.StructType([
    T.StructField("optimized_html", T.StringType()),
    T.StructField("title_tag", T.StringType()),
    T.StructField("meta_description", T.StringType()),
    T.StructField("slug", T.StringType()),
    T.StructField("og_title", T.StringType()),
    T.StructField("og_description", T.StringType()),
    T.StructField("schema_markup", T.StringType()),   # arbitrary JSON kept as text
    T.StructField("alt_texts", T.MapType(T.StringType(), T.StringType())),
    T.StructField("internal_link_suggestions", LINKS_TYPE),
    T.StructField("changes_summary", T.StringType()),
])
TEXT_FIELDS = ("optimized_html", "title_tag", "meta_description", "slug", "og_title", "og_description",
               "changes_summary")


def extract_json_text(raw: Column) -> Column:
    """Trimmed text; when it starts with a fence, drop the first line and
    the last line if that line (trimmed) is the fence; trim again."""
    s = strip_ws(raw)
    lines = F.split(s, "\n", -1)
    n = F.size(lines)
    closed = strip_ws(F.element_at(lines, -1)) == FENCE
    inner = F.when(closed, F.array_join(F.slice(lines, 2, F.greatest(n - 2, F.lit(0))), "\n")).otherwise(
        F.array_join(F.slice(lines, 2, F.greatest(n - 1, F.lit(0))), "\n"))
    return F.when(s.startswith(FENCE), strip_ws(inner)).otherwise(s)


def parse_responses(df: DataFrame, raw: str = "raw") -> DataFrame:
    """X10 + X11 + X12: extracted text, validity and the ten output fields
    with their defaults (``""`` / empty list / empty map)."""
    d = df.withColumn("extracted", extract_json_text(F.col(raw)))
    d = d.withColumn("valid", F.try_parse_json(F.col("extracted")).isNotNull())
    d = d.withColumn("_o", F.when(F.col("valid"), F.from_json(F.col("extracted"), OUTPUT_SCHEMA)))
    cols = [F.coalesce(F.col(f"_o.{c}"), F.lit("")).alias(c) for c in TEXT_FIELDS]
    return d.select(
        *df.columns, "extracted", "valid", *cols,
        F.col("_o.schema_markup").alias("schema_markup"),
        F.coalesce(F.col("_o.alt_texts"), F.create_map().cast("map<string,string>")).alias("alt_texts"),
        F.coalesce(F.col("_o.internal_link_suggestions"), F.array().cast(LINKS_TYPE)).alias(
            "internal_link_suggestions"),
    )


def correction_batch(invalid: DataFrame, context: str = "context", raw: str = "raw") -> DataFrame:
    """For each invalid response, the three messages of the retry:
    the original request, the bad reply, the correction quoting its first
    2,000 characters."""
    msgs = F.array(
        F.struct(F.lit("user").alias("role"), F.col(context).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col(raw).alias("content")),
        F.struct(F.lit("user").alias("role"),
                 F.format_string(CORRECTION_PROMPT, F.substring(F.col(raw), 1, CORRECTION_CHARS)).alias("content")),
    )
    return invalid.select("article_id", F.posexplode(msgs).alias("turn", "_m")).select(
        "article_id", F.col("turn").cast("int").alias("turn"), F.col("_m.role").alias("role"),
        F.col("_m.content").alias("content"))


def prompt_template_join(articles: DataFrame, prompts: DataFrame, language: str = "language") -> DataFrame:
    """System prompt per article language, the voice text substituted for
    the placeholder.  The prompt table has one row per supported language, so
    its broadcast is bounded."""
    p = prompts.select(F.col("language").alias("_lang"),
                       F.replace(F.col("system_prompt"), F.lit("{brand_voice_content}"),
                                 F.coalesce(F.col("brand_voice"), F.lit(""))).alias("system_prompt"))
    return articles.join(F.broadcast(p), F.col(language) == F.col("_lang"), "left").drop("_lang")


def prompt_context(df: DataFrame) -> Column:
    """One JSON document of the nine context fields (non-ASCII kept)."""
    return F.to_json(F.struct(
        "title", "body_html", "language", "main_keyword", "secondary_keywords", "question_keywords",
        "lsi_keywords", "suggested_headings", "competitor_heading_structure"), {"ignoreNullFields": "false"})


def article_writeback(parsed: DataFrame) -> DataFrame:
    """K2: the article update: body, title from the title tag, handle from the
    slug; the status is never changed."""
    return parsed.where(F.col("valid")).select(
        "article_id", F.col("optimized_html").alias("body_html"), F.col("title_tag").alias("title"),
        F.col("slug").alias("handle"))


def metafield_rows(parsed: DataFrame, include_alt_texts: bool = False) -> DataFrame:
    """K3: wide to long.  Three text metafields when non-empty, the schema
    markup as JSON when present (alt texts optionally, off by default)."""
    st = "single_line_text_field"
    items = [
        F.struct(F.lit("seo").alias("namespace"), F.lit(k).alias("key"), F.col(k).alias("value"),
                 F.lit(st).alias("type"))
        for k in ("meta_description", "og_title", "og_description")
    ]
    items.append(F.struct(F.lit("seo").alias("namespace"), F.lit("schema_markup").alias("key"),
                          F.col("schema_markup").alias("value"), F.lit("json").alias("type")))
    if include_alt_texts:
        items.append(F.struct(F.lit("seo").alias("namespace"), F.lit("alt_texts").alias("key"),
                              F.when(F.size("alt_texts") > 0, F.to_json("alt_texts")).alias("value"),
                              F.lit("json").alias("type")))
    rows = parsed.where(F.col("valid")).select("article_id", F.inline(F.array(*items)))
    return rows.where(F.col("value").isNotNull() & (F.col("value") != ""))
