"""Quality rules with risk-controlled cutoffs (native: DataFrame functions only).

Each rule rejects a text whose signal lies beyond a cutoff.  The cutoffs are
not chosen by eye.  A labelled holdout of good texts (quality 1) decides, in
each stratum (language), how strict each rule may be: a cutoff is certified
when the hypothesis "this cutoff rejects more than ``alpha`` of the good texts"
is rejected by the exact binomial test, whose p-value is P(Bin(n, alpha) <= k)
for k of the n good texts rejected.  This is the test that inverts the
Clopper-Pearson upper bound.

Multiple testing: the cutoffs of one rule are nested, so they are tested from
the most lenient on and testing stops at the first failure (fixed sequence; no
correction inside a rule).  Over rules and strata the level is divided
(Bonferroni).  So with probability at least ``1 - delta`` no certified cutoff
of any rule and stratum exceeds its risk, and the rules together reject at most
``risk`` of the good texts of any stratum.  A stratum with too few labelled
texts certifies nothing and its texts are kept unless the base rule fails.

Defined results: a null text has no words; a null or unseen language is the
stratum of null (its texts are kept when it certifies nothing); a null id stays
null; repeated rows are judged one by one.  The holdout has one observation for
each distinct text of a stratum and at most one for each labelled id (of several
texts under one id the one with the least MD5), good only if all labels of the id
say so: copies are no further evidence.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import SPACES, staged, table

#: Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


@dataclass(frozen=True)
class Rule:
    """A signal, and its cutoffs from the most lenient to the strictest; the
    rule rejects above the cutoff, or below it."""

    signal: str
    cutoffs: tuple[float, ...]
    above: bool = True

    def rejects(self, signal: Column, cutoff: Column) -> Column:
        return signal > cutoff if self.above else signal < cutoff


#: The cutoffs are a fixed grid, chosen without looking at any holdout.
RULES = (
    Rule("symbol_share", (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01)),
    Rule("dup_line_share", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("repeat_share", (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("exclaim_share", (1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    Rule("word_chars_mean", (20.0, 15.0, 12.0, 10.0, 9.0, 8.0)),
    Rule("word_chars_mean", (1.5, 2.0, 2.5, 3.0, 3.5, 4.0), above=False),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: inside a higher-order
    function it is a bound variable, which the optimizer cannot copy into
    every use."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str, put: str = "") -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(put))
    return text


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array."""
    return F.array_remove(F.split(_without(text, SPACES[1:], " "), " "), "")


def repeated_window_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in ``words``.
    Windows are compared as 64-bit hashes of their three words."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _let(placed, lambda s: F.filter(
            s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
            lambda s: s["n"])

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(
        windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))


def text_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 stratum_col: str | None = "lang") -> DataFrame:
    """One row per row of ``docs``: the id, the stratum and the counts that the
    rules use.  Everything is counted inside the row; nothing is exploded."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    of_words = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_window_words(w).cast("long").alias("n_repeat_words")))
    of_lines = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    stratum = F.col(stratum_col) if stratum_col else F.lit(None)
    return docs.select(
        F.col(id_col).alias("doc_id"), stratum.cast("string").alias("stratum"), F.md5(text.cast("binary")).alias("text_md5"),
        of_words.alias("w"), of_lines.alias("l"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.octet_length(text) - F.octet_length(_without(text, "!"))).cast("long").alias("n_exclaims"),
    ).select("doc_id", "stratum", "text_md5", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines",
             "w.n_repeat_words", "l.n_lines", "n_exclaims")


def signals(metrics: DataFrame) -> DataFrame:
    """Metrics with the base verdict and the signals of the rules."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b).cast("double")).otherwise(F.lit(0.0))

    return metrics.select(
        "*",
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_exclaims", "n_words").alias("exclaim_share"),
        share("word_chars", "n_words").alias("word_chars_mean"))


def _ln_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, shifted by 8 so that it is exact to about
    1e-13."""
    z = x.cast("double") + 9.0
    shifted = sum((F.log(x.cast("double") + float(j)) for j in range(2, 9)), F.log(x.cast("double") + 1.0))
    series = (1.0 / 12 - (1.0 / 360 - (1.0 / 1260 - 1.0 / (1680 * z * z)) / (z * z)) / (z * z)) / z
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shifted


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k).  Terms are summed from k downwards, each from the one
    before; below 40 + 12 standard deviations the rest is under 1e-30 of the
    sum.  At or beyond the mean the tail is reported as 1 (never significant).
    """
    top = (_ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
           + k * math.log(p) + (n - k) * math.log1p(-p))
    reach = (F.lit(40.0) + 12.0 * F.sqrt(n * (p * (1 - p)))).cast("long")
    steps = F.sequence(F.lit(0).cast("long"), F.least(reach, k))
    total = F.aggregate(
        steps, F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")),
        lambda a, j: F.struct(
            (a["s"] + a["t"]).alias("s"),
            (a["t"] * (k - j).cast("double") * (1 - p) / ((n - k + j + 1).cast("double") * p)).alias("t")),
        lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def certified_cutoffs(judged: DataFrame, good: DataFrame, rules: tuple[Rule, ...] = RULES,
                      risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """(stratum, cutoffs): per stratum an array with the strictest certified
    cutoff of each rule, or null.  ``judged`` has the signals, ``good`` the ids
    of the labelled good texts.  Texts that fail the base rule are no part of
    the holdout, since the method's verdict is never asked for them."""
    names = sorted({r.signal for r in rules})
    held = judged.where(~F.col("base_failed")).join(good, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct("text_md5", "stratum", *names)).alias("one")).select("one.*").dropDuplicates(["stratum", "text_md5"])
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.array(*[F.sum(r.rejects(F.col(r.signal), F.lit(c)).cast("long")) for c in r.cutoffs])
                  for r in rules]).alias("k"))
    strata = counts.agg(F.count(F.lit(1)).alias("n_strata"))
    grid = F.array(*[F.array(*[F.lit(c) for c in r.cutoffs]) for r in rules])
    tests = (
        counts.crossJoin(strata)  # one row: the number of strata
        .select("stratum", "n", "n_strata", "k", F.posexplode(grid).alias("rule", "cutoffs"))
        .select("stratum", "n", "n_strata", "rule", F.col("k")[F.col("rule")].alias("k"),
                F.posexplode("cutoffs").alias("step", "cutoff"))
        .select("stratum", "rule", "step", "cutoff", (
            binomial_tail(F.col("n"), F.col("k")[F.col("step")], risk / len(rules))
            <= delta / (len(rules) * F.col("n_strata"))).alias("safe")))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    chosen = (tests.withColumn("certified", F.min("safe").over(so_far)).where("certified")
              .groupBy("stratum", "rule").agg(F.max_by("cutoff", "step").alias("cutoff")))
    return chosen.groupBy("stratum").agg(
        F.array(*[F.max(F.when(F.col("rule") == i, F.col("cutoff"))) for i in range(len(rules))]).alias("cutoffs"))


def good_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
            .agg(F.min(F.coalesce(F.col(label_col), F.lit(0))).alias("q")).where("q = 1").select("doc_id"))


def quality_rules(docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
                  risk: float = 0.05, delta: float = 0.1) -> DataFrame:
    """Metrics, base verdict and final verdict of every row of ``docs``
    (doc_id, text, lang) under cutoffs certified on ``labels`` (doc_id,
    quality)."""
    judged = signals(staged(text_metrics(docs), "quality"))
    cutoffs = certified_cutoffs(judged, good_ids(labels), rules, risk, delta).withColumnRenamed("stratum", "_stratum")
    rejected = F.lit(False)
    for i, r in enumerate(rules):
        rejected = rejected | F.coalesce(r.rejects(F.col(r.signal), F.col("cutoffs")[i]), F.lit(False))
    return judged.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def oracle_op3(rules: tuple[Rule, ...] = RULES, risk: float = 0.05, delta: float = 0.1,
               documents: str = "documents") -> str:
    """The same result as DuckDB SQL, with the binomial tail from lgamma."""
    a, m = risk / len(rules), len(rules)
    grid = " UNION ALL ".join(
        f"SELECT {i} AS rule, {j} AS step, CAST({c} AS DOUBLE) AS cutoff"
        for i, r in enumerate(rules) for j, c in enumerate(r.cutoffs))
    value = "CASE g.rule " + " ".join(f"WHEN {i} THEN s.{r.signal}" for i, r in enumerate(rules)) + " END"
    beyond = "CASE WHEN g.rule IN (" + ", ".join(str(i) for i, r in enumerate(rules) if not r.above) + \
        f") THEN {value} < g.cutoff ELSE {value} > g.cutoff END"
    return f"""
    WITH t AS (
      SELECT doc_id, lang AS stratum, coalesce(text, '') AS text,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
      FROM {documents}),
    v AS (
      SELECT *, CASE WHEN len(w) < 3 THEN CAST([] AS VARCHAR[]) ELSE
             list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END AS win
      FROM t),
    h AS (SELECT *, map_from_entries(list_filter(map_entries(list_histogram(win)), lambda e: e.value > 1)) AS twice FROM v),
    m AS (
      SELECT doc_id, stratum, md5(text) AS text_md5, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CASE WHEN cardinality(twice) = 0 THEN 0 ELSE CAST(len(list_filter(range(1, len(w) + 1),
               lambda i: (i <= len(win) AND map_contains(twice, win[i]))
                 OR (i >= 2 AND i - 1 <= len(win) AND map_contains(twice, win[i - 1]))
                 OR (i >= 3 AND map_contains(twice, win[i - 2])))) AS BIGINT) END AS n_repeat_words
      FROM h),
    s AS (
      SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words) AS base_failed,
             CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END AS symbol_share,
             CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
             CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_share,
             CASE WHEN n_words > 0 THEN n_exclaims::DOUBLE / n_words ELSE 0 END AS exclaim_share,
             CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS word_chars_mean
      FROM m),
    good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
    held AS (
      SELECT * FROM (
        SELECT * FROM s WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY text_md5, stratum NULLS FIRST) = 1)
      QUALIFY row_number() OVER (PARTITION BY stratum, text_md5) = 1),
    g AS ({grid}),
    c AS (
      SELECT s.stratum, g.rule, g.step, g.cutoff, count(*) AS n,
             CAST(sum(CAST({beyond} AS INTEGER)) AS BIGINT) AS k
      FROM held s CROSS JOIN g GROUP BY ALL),
    p AS (
      SELECT *, (SELECT count(*) FROM (SELECT DISTINCT stratum FROM held)) AS strata,
             CASE WHEN k >= n * {a!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
               exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({a!r}) + (n - i) * ln(1 - {a!r})))) END AS tail
      FROM c),
    ok AS (
      SELECT *, min(CAST(tail <= {delta!r} / ({m} * strata) AS INTEGER))
                  OVER (PARTITION BY stratum, rule ORDER BY step) AS certified FROM p),
    cut AS (SELECT stratum, rule, max_by(cutoff, step) AS cutoff FROM ok WHERE certified = 1 GROUP BY ALL),
    bad AS (
      SELECT DISTINCT s.doc_id FROM s JOIN cut g ON s.stratum IS NOT DISTINCT FROM g.stratum WHERE {beyond})
    SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           (NOT base_failed AND s.doc_id NOT IN (SELECT doc_id FROM bad WHERE doc_id IS NOT NULL)) AS kept
    FROM s"""
