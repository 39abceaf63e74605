"""Heading repair.

All of it is per-row array work on one article: its headings are extracted
once, repaired with higher-order functions and written back.  No shuffle: an
article is never split, and nothing groups articles together.

Headings in comments and raw-text elements are none.

Semantics, in order:
  W1  first H1 kept, later H1s become H2; no H1 in a non-blank body -> an H1
      with the title is inserted before the first element;
  W2  level_i = min(raw_i, level_{i-1} + 1), level_0 = 1;
  W3  with an H1 and an H2: intro starts before the H1, ends before the first
      H2 (even when that H2 comes first);
  W4  the last H2 whose lower-cased text contains a closing word: conclusion
      starts before it and ends before the next heading in the same container
      (a heading inside a sibling element does not end it), else after the last
      element of that container;
  W8  raw jumps of more than one level (diagnostic of W2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.html import (
    HEADING_RE,
    RAW_MARK,
    escape_text,
    heading_containers,
    heading_levels,
    heading_texts,
    hidden_parts,
    hide_raw,
    section_end,
    show_raw,
)

# Words marking a closing section (matched as substrings of the
# lower-cased H2 text).
CONCLUSION_WORDS = ("conclusion", "summary", "résumé", "synthèse", "en résumé", "pour conclure")

#: A tag that may hold headings: any but headings, paragraphs and line breaks.
NESTING_RE = r"(?i)<(?!(?:h[1-6]|p|br|hr|img)\b)[a-z]"
# Stands for the closing marker at the end of a container until the text is put
# together again.
_END_MARK = "\ue002"

# Section markers written into the HTML.
INTRO_START = "<!-- INTRODUCTION START -->"
INTRO_END = "<!-- INTRODUCTION END -->"
CONCLUSION_START = "<!-- CONCLUSION START -->"
CONCLUSION_END = "<!-- CONCLUSION END -->"


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def normalise_levels(levels: Column) -> Column:
    """W2 over an ``array<int>``: each level at most one deeper than the previous
    repaired level; the virtual level before the first is 1.

    Unrolled, the recurrence is the minimum of raw_j + (i - j) over all j <= i and
    of i + 1 (1-based).  Levels are 1 to 6, so a heading more than 5 places back
    can never be the minimum: one look back per place, linear in the headings."""
    def repaired(raw: Column) -> Column:
        return F.transform(raw, lambda x, i: F.least(
            x, i + 2, *[F.get(raw, i - back) + back for back in range(1, 6)]))

    return F.transform(F.array(levels), repaired)[0]


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` worked out once a row.  A generator stands
    between them and their uses: a filter or a lambda on a plain column gets
    its whole expression put in, and would work it out again for every use and
    every element."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_heading_plan(articles: DataFrame, body: str = "body_html", title: str = "title") -> DataFrame:
    """Add the per-article heading plan as array columns:

    ``raw_levels``      levels as written;
    ``h1_inserted``     whether W1 inserts an H1;
    ``fixed_levels``    after W1 (with the inserted H1 first, if any);
    ``fixed_texts``     heading texts aligned with ``fixed_levels``;
    ``levels``          after W2;
    ``intro_start``/``intro_end``        1-based positions in ``levels`` (0 = none);
    ``conclusion_at``/``conclusion_end`` idem; ``conclusion_end`` is
                        ``size(levels) + 1`` when no heading ends the conclusion;
    ``containers``      per heading of ``levels`` the element that holds it (id, path);
    ``hidden_body``     the body without comments and raw text (``hide_raw``).
    """
    root = F.struct(F.lit(0).alias("id"), F.lit("").alias("path"))
    df = computed(articles, hidden_body=hide_raw(F.col(body)))
    df = computed(df, raw_levels=heading_levels("hidden_body", hidden=True), _texts=heading_texts("hidden_body", hidden=True))
    first_h1 = F.array_position("raw_levels", 1)
    insert = (first_h1 == 0) & (F.regexp_replace(F.coalesce(F.col(body), F.lit("")), r"\s+", "") != "")
    df = computed(df, h1_inserted=insert, _first=first_h1)
    demoted = F.transform("raw_levels", lambda l, i: F.when((l == 1) & (i + 1 > F.col("_first")), F.lit(2)).otherwise(l))
    df = computed(
        df, fixed_levels=F.when(F.col("h1_inserted"), F.concat(F.array(F.lit(1)), F.col("raw_levels"))).otherwise(demoted),
        fixed_texts=F.when(F.col("h1_inserted"), F.concat(F.array(F.coalesce(F.col(title), F.lit(""))), F.col("_texts")))
        .otherwise(F.col("_texts")))
    df = computed(df, levels=normalise_levels(F.col("fixed_levels")))
    words = _lit_array(CONCLUSION_WORDS)
    closing = F.array_max(F.transform(F.arrays_zip("levels", "fixed_texts"), lambda h, i: F.when(
        (h["levels"] == 2) & F.exists(words, lambda w: F.contains(F.lower(h["fixed_texts"]), w)), i + 1).otherwise(0)))
    df = computed(df, conclusion_at=F.coalesce(closing, F.lit(0)).cast("int"))
    # last, and no generator: only the queries that read it pay for it
    inside = F.when(F.col("hidden_body").rlike(NESTING_RE), heading_containers(F.col("hidden_body"))).otherwise(
        F.transform("raw_levels", lambda _: root))
    df = df.withColumn("containers", F.when(F.col("h1_inserted"), F.concat(F.array(root), inside)).otherwise(inside))
    h1 = F.array_position("levels", 1)
    h2 = F.array_position("levels", 2)
    both = (h1 > 0) & (h2 > 0)

    def section_ends(s: Column) -> Column:
        # the next heading beside it; the positions after the last are past the end
        return F.get(F.filter(F.sequence(s["at"] + 1, F.size(s["of"]) + 1), lambda k: F.coalesce(
            F.try_element_at(s["of"], k)["id"] == F.try_element_at(s["of"], s["at"])["id"], F.lit(True))), F.lit(0))

    bound = F.array(F.struct(F.col("containers").alias("of"), F.col("conclusion_at").alias("at")))
    return (
        df.withColumn("intro_start", F.when(both, h1).otherwise(0).cast("int"))
        .withColumn("intro_end", F.when(both, h2).otherwise(0).cast("int"))
        .withColumn("conclusion_end", F.when(F.col("conclusion_at") > 0, F.transform(bound, section_ends)[0])
                    .otherwise(0).cast("int"))
        .drop("_texts", "_first")
    )


def heading_rows(plan: DataFrame, keys=("article_id",)) -> DataFrame:
    """One row per heading after W1: ``seq`` is 0 for an inserted H1, else the
    1-based position of the heading in the original document."""
    z = F.arrays_zip(F.col("fixed_levels").alias("fixed_level"), F.col("levels").alias("level"),
                     F.col("fixed_texts").alias("heading_text"))
    return plan.select(*keys, "h1_inserted", F.posexplode_outer(z).alias("_i", "_h")).where(
        F.col("_h").isNotNull()).select(
        *keys,
        (F.col("_i") + F.when(F.col("h1_inserted"), 0).otherwise(1)).cast("int").alias("seq"),
        F.col("_h.fixed_level").alias("fixed_level"),
        F.col("_h.level").alias("level"),
        F.col("_h.heading_text").alias("heading_text"),
    )


def position_to_seq(pos: Column) -> Column:
    """1-based position in ``levels`` -> ``seq`` of ``heading_rows``."""
    return (pos - F.when(F.col("h1_inserted"), 1).otherwise(0)).cast("int")


def skip_columns() -> list[Column]:
    """W8 columns of a heading plan: headings, raw jumps of more than one level
    (previous of the first is 1) and headings whose level W2 changed."""
    jumps = F.aggregate(
        "fixed_levels",
        F.struct(F.lit(0).alias("n"), F.lit(1).alias("prev")),
        lambda acc, x: F.struct((acc["n"] + F.when(x > acc["prev"] + 1, 1).otherwise(0)).alias("n"),
                                x.alias("prev")),
        lambda acc: acc["n"],
    )
    changed = F.size(F.filter(F.arrays_zip("fixed_levels", "levels"),
                              lambda z: z["fixed_levels"] != z["levels"]))
    return [F.size("fixed_levels").cast("int").alias("headings"), jumps.cast("int").alias("skips"),
            changed.cast("int").alias("corrected")]


def heading_skips(plan: DataFrame) -> DataFrame:
    """The skip columns per article."""
    return plan.select("article_id", *skip_columns())


def _markers(k: Column) -> Column:
    """Markers written before the heading at 1-based position ``k``, in the
    order they are inserted."""
    return F.concat(
        F.when((F.col("intro_start") > 0) & (k == F.col("intro_start")), F.lit(INTRO_START)).otherwise(""),
        F.when((F.col("intro_end") > 0) & (k == F.col("intro_end")), F.lit(INTRO_END)).otherwise(""),
        F.when((F.col("conclusion_at") > 0) & (k == F.col("conclusion_at")), F.lit(CONCLUSION_START)).otherwise(""),
        F.when((F.col("conclusion_end") > 0) & (k == F.col("conclusion_end")), F.lit(CONCLUSION_END)).otherwise(""),
    )


def normalize_html_structure(articles: DataFrame, body: str = "body_html", title: str = "title") -> DataFrame:
    """Adds ``normalized_html``: the body with repaired heading tags, the
    inserted H1 and the section markers; every other byte unchanged.  A blank
    body is returned as it is."""
    # Arrays used inside the lambda are materialised first: an inline
    # expression would be re-evaluated for every piece.
    plan = with_heading_plan(articles, body, title)
    shift = F.when(F.col("h1_inserted"), 1).otherwise(0)
    at = section_end(F.col("hidden_body"), F.col("conclusion_at") - shift,
                     F.try_element_at("containers", F.col("conclusion_at"))["id"])
    to_end = (F.col("conclusion_at") > 0) & (F.col("conclusion_end") == F.size("levels") + 1)
    plan = (plan.withColumn("_at", F.when(to_end, at))
            .withColumn("_body", F.when(F.col("_at").isNull(), F.col("hidden_body")).otherwise(F.concat(
                F.expr("substring(hidden_body, 1, _at)"), F.lit(_END_MARK), F.expr("substring(hidden_body, _at + 1)"))))
            .withColumn("_pieces", F.split("_body", HEADING_RE, -1))
            .withColumn("_attrs", F.regexp_extract_all("_body", F.lit(HEADING_RE), 2))
            .withColumn("_inner", F.regexp_extract_all("_body", F.lit(HEADING_RE), 3)))
    pieces, attrs, inner = F.col("_pieces"), F.col("_attrs"), F.col("_inner")

    def one(piece, i):
        # piece i (0-based) follows original heading i (1-based)
        k = i + shift  # position of that heading in ``levels``
        lvl = F.try_element_at(F.col("levels"), k).cast("string")
        tag = F.concat(_markers(k), F.lit("<h"), lvl, F.try_element_at(attrs, i), F.lit(">"),
                       F.try_element_at(inner, i), F.lit("</h"), lvl, F.lit(">"))
        return F.when(i == 0, piece).otherwise(F.concat(tag, piece))

    rebuilt = F.array_join(F.transform(pieces, one), "")
    inserted_h1 = F.concat(_markers(F.lit(1)), F.lit("<h1>"),
                           escape_text(F.coalesce(F.col(title), F.lit(""))), F.lit("</h1>"))
    blank = F.regexp_replace(F.coalesce(F.col(body), F.lit("")), r"\s+", "") == ""
    mark = F.when(F.col("_at").isNotNull(), F.lit(_END_MARK)).otherwise(F.lit(""))  # "" replaces nothing
    # a title may hold any character, so it comes in after the hidden parts
    out = (
        plan.withColumn("_rebuilt", F.replace(rebuilt, mark, F.lit(CONCLUSION_END)))
        .withColumn("_hidden", hidden_parts(F.col(body)))
        .withColumn("_shown", show_raw(F.col("_rebuilt"), F.col("_hidden")))
        .withColumn("_lead", F.when(F.col("h1_inserted"), show_raw(F.regexp_extract("_rebuilt", rf"^[^<{RAW_MARK}]*", 0),
                                                                  F.col("_hidden"))))
        .withColumn("_with_h1", F.when(
            F.col("h1_inserted"),
            F.concat(F.col("_lead"), inserted_h1, F.expr("substring(_shown, char_length(_lead) + 1)")),
        ).otherwise(F.col("_shown")))
        .withColumn("normalized_html", F.when(blank, F.coalesce(F.col(body), F.lit(""))).otherwise(F.col("_with_h1")))
    )
    return out.drop("_rebuilt", "_lead", "_with_h1", "_pieces", "_attrs", "_inner", "_at", "_body", "_hidden", "_shown",
                    "hidden_body", "containers")
