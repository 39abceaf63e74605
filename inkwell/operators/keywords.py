"""Keyword research: report parsing, ranking, routing (SURVEY 2.1 S4-S6,
2.6 W5-W6, 2.4 J6, 2.8 X1, X2, X21, X25)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.values import lines_of, parse_float, parse_int, strip_ws

# Keyword database per language (the default for any other
# language is the second entry).
DATABASE_BY_LANGUAGE = {"fr": "ca"}
DEFAULT_DATABASE = "us"
# Search country per language and extra results requested.
COUNTRY_BY_LANGUAGE = {"fr": "ca"}
DEFAULT_COUNTRY = "us"
SEARCH_RESULTS = 5
SEARCH_OVERFETCH = 2

SECONDARY_LIMIT = 5
QUESTION_LIMIT = 3


def keyword_overview_parse(reports: DataFrame) -> DataFrame:
    """``(report_id, seed, report)`` -> first data row as
    ``keyword, volume, difficulty, cpc``.  Fewer than two non-blank lines or
    fewer than four fields gives ``(seed, 0, 0.0, 0.0)``."""
    lines = lines_of("report")
    fields = F.split(F.try_element_at(F.col("_lines"), F.lit(2)), ";", -1)
    ok = (F.size("_lines") >= 2) & (F.size(F.col("_f")) >= 4)
    return (
        reports.withColumn("_lines", lines)
        .withColumn("_f", F.when(F.size("_lines") >= 2, fields))
        .select(
            "report_id", "seed",
            F.when(ok, strip_ws(F.col("_f")[0])).otherwise(F.col("seed")).alias("keyword"),
            F.when(ok, parse_int(F.col("_f")[1])).otherwise(F.lit(0).cast("bigint")).alias("volume"),
            F.when(ok, parse_float(F.col("_f")[2])).otherwise(F.lit(0.0)).alias("difficulty"),
            F.when(ok, parse_float(F.col("_f")[3])).otherwise(F.lit(0.0)).alias("cpc"),
        )
    )


def main_keyword(overview: DataFrame) -> DataFrame:
    """Overview keyword when non-empty, else the seed."""
    return overview.select(
        "report_id", "seed",
        F.coalesce(F.nullif(F.col("keyword"), F.lit("")), F.col("seed")).alias("main_keyword"),
        F.coalesce("volume", F.lit(0).cast("bigint")).alias("main_kw_volume"),
        F.coalesce("difficulty", F.lit(0.0)).alias("main_kw_difficulty"),
    )


def _data_lines(reports: DataFrame, page_rows: int) -> DataFrame:
    """Non-blank lines after the header, with their global report position."""
    page = F.coalesce(F.col("page"), F.lit(0)) if "page" in reports.columns else F.lit(0)
    return reports.select(
        "seed", page.alias("page"),
        F.posexplode(F.slice(lines_of("report"), 2, 1 << 30)).alias("_i", "line"),
    ).withColumn("pos", (F.col("page") * page_rows + F.col("_i") + 1).cast("int"))


def related_keywords_parse(reports: DataFrame, page_rows: int = 20) -> DataFrame:
    """``(seed, page, report)`` -> one row per data line with at least
    three ``;`` fields, trimmed and cast with 0 defaults, report order kept."""
    d = _data_lines(reports, page_rows).withColumn("_f", F.split("line", ";", -1))
    return d.where(F.size("_f") >= 3).select(
        "seed", "pos",
        strip_ws(F.col("_f")[0]).alias("keyword"),
        parse_int(F.col("_f")[1]).alias("volume"),
        parse_float(F.col("_f")[2]).alias("difficulty"),
    )


def question_keywords_parse(reports: DataFrame, page_rows: int = 20) -> DataFrame:
    """Every non-blank line after the header, trimmed, is one question."""
    return _data_lines(reports, page_rows).select(
        "seed", "pos", strip_ws("line").alias("question")
    )


def keyword_ratio(volume: F.Column | str = "volume", difficulty: F.Column | str = "difficulty") -> F.Column:
    """Volume / max(difficulty, 1)."""
    v = F.col(volume) if isinstance(volume, str) else volume
    d = F.col(difficulty) if isinstance(difficulty, str) else difficulty
    return v.cast("double") / F.greatest(d, F.lit(1.0))


def secondary_keywords(related: DataFrame, limit: int = SECONDARY_LIMIT) -> DataFrame:
    """Per seed, the ``limit`` keywords with the highest ratio; ties keep
    report order.  ``row_number() <= k`` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so a huge seed is cut map-side."""
    w = Window.partitionBy("seed").orderBy(F.desc("ratio"), F.asc("pos"))
    return (
        related.withColumn("ratio", keyword_ratio())
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= limit)
        .select("seed", F.col("rank").cast("int").alias("rank"), "keyword", "ratio")
    )


def question_top(questions: DataFrame, limit: int = QUESTION_LIMIT) -> DataFrame:
    """First ``limit`` questions per seed in report order."""
    w = Window.partitionBy("seed").orderBy("pos")
    return (
        questions.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= limit)
        .select("seed", F.col("rank").cast("int").alias("rank"), "question")
    )


def _lookup(col: F.Column, mapping: dict[str, str], default: str) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def database_for_language(language: F.Column | str = "language",
                          mapping: dict[str, str] | None = None,
                          default: str = DEFAULT_DATABASE) -> F.Column:
    """Keyword database per language (a two-row lookup inlined as CASE)."""
    col = F.col(language) if isinstance(language, str) else language
    return _lookup(col, DATABASE_BY_LANGUAGE if mapping is None else mapping, default)


def search_locale(df: DataFrame, keyword: str = "keyword", language: str = "language",
                  num: int = SEARCH_RESULTS) -> DataFrame:
    """Search request per keyword: country, language, results asked."""
    return df.select(
        "*",
        _lookup(F.col(language), COUNTRY_BY_LANGUAGE, DEFAULT_COUNTRY).alias("gl"),
        F.col(language).alias("hl"),
        F.lit(num + SEARCH_OVERFETCH).alias("num"),
    )
