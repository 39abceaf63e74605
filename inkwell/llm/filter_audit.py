"""Filter interaction audit by Hart-Mas-Colell potentials (native).

Filters that reject documents overlap: what a filter removes depends on the
filters applied before it.  For every part (source) the audit says what each
filter removes at every step of every order, and what share of the whole
removal it deserves whatever the order.

The game: a coalition is a set of filters, its worth v(S) the documents that at
least one filter of S fails.  All 2^n worths of a part follow from the counts of
its documents by failure pattern, so no order is ever run over the documents.

* A step that applies filter i after the filters of S removes v(S + i) - v(S).
* The potential is computed recursively over the coalitions, from small to
  large: P({}) = 0 and P(S) = (v(S) + sum over i in S of P(S - i)) / |S|.  The
  Shapley value of i is P(N) - P(N - i).  Potentials are kept times n!, where
  every division is exact, so ``shapley`` is the filter's removals summed over
  all n! orders, as an integer.

The same differences in the games of good and of toxic documents give the
labelled documents lost.

Scale: one pass over the texts leaves a narrow row per document (id, part,
pattern, SHA-256 of the text).  The smallest id of a text is a partial
aggregate, and copies are recognised by joining on (text digest, id), a key
that no group of copies makes hot.  Counts by (part, pattern) are partial
aggregates, so a hot source costs a row a task.  Only 2^n counts a part are
ever gathered.

Defined results: a null text is empty; a null part is the empty string; a null
id has no smaller id and no label; rows that repeat an id and its text are
equal, not copies of a smaller id; an id with several labels is good (toxic) if
any of them says so; without documents there are no rows; other columns of the
inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import staged, table
from inkwell.llm.quality import words_of


@dataclass(frozen=True)
class Filter:
    """A letter, and the condition on (text, words) under which it rejects; a
    filter without a condition rejects repeated texts."""

    letter: str
    fails: Callable[[Column, Column], Column] | None


def _too_few_words(text: Column, words: Column) -> Column:
    return F.size(words) < 50


def _few_distinct_words(text: Column, words: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < 65 * F.size(words)


def _many_capitals(text: Column, words: Column) -> Column:
    return 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text)


def _has_symbols(text: Column, words: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: The filters of the contract; E compares whole texts over the whole table.
FILTERS = (
    Filter("A", _too_few_words),
    Filter("B", _few_distinct_words),
    Filter("C", _many_capitals),
    Filter("D", _has_symbols),
    Filter("E", None),
)


def _marks(docs: DataFrame, filters: tuple[Filter, ...], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(doc_id, part, digest, mask, n): rows of equal id, part and text are one
    row with their count; ``mask`` has the bits of the filters on the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a one-element array binds the words, so that they are split once
    mask = F.transform(F.array(words_of(F.col("text"))), lambda w: sum(
        (F.when(f.fails(F.col("text"), w), F.lit(1 << i)).otherwise(F.lit(0))
         for i, f in enumerate(filters) if f.fails), F.lit(0)))[0]
    return (rows.select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                        mask.alias("mask"))
            .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))


def _label_bits(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) of the ids with either label."""
    return (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max((F.coalesce(F.col("quality"), F.lit(0)) == 1).cast("long")).alias("good"),
                 F.max((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("long")).alias("toxic"))
            .where("good + toxic > 0"))


def failure_counts(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS,
                   id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, docs, good, toxic): documents of a part that fail exactly
    the filters of ``mask`` (bit i: filter i)."""
    marks = staged(_marks(docs, filters, id_col, text_col, part_col), "audit-marks")
    bits = staged(_label_bits(labels), "audit-labels")
    # null ids are spread: they never meet a label
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1024)) + 1).otherwise(F.lit(0))
    known = (marks.withColumn("salt", spread)
             .join(bits.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left"))
    repeat = [i for i, f in enumerate(filters) if f.fails is None]
    if repeat:
        first = (marks.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
                 .withColumn("first", F.lit(True)))
        known = known.join(first, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(
            F.col("first").isNull() & F.col("doc_id").isNotNull(), F.lit(sum(1 << i for i in repeat))).otherwise(F.lit(0)))
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def potentials(worth: Column, n: int) -> Column:
    """Array of n! * P(S) for the coalitions S = 0 .. 2^n - 1, from the array of
    their worths v(S).  S - i is a smaller number than S, so one fold over the
    coalitions in ascending order has every potential that it needs."""
    def grown(so_far: Column, s: Column) -> Column:
        below = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(so_far, s - F.lit(1 << i))).otherwise(F.lit(0))
                 for i in range(n)]
        whole = F.get(worth, s) * F.lit(math.factorial(n)) + sum(below, F.lit(0).cast("long"))
        return F.concat(so_far, F.array(F.call_function("div", whole, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("long")), grown)


def _plans(letters: str) -> list[tuple[str, int, int, int]]:
    """(order, step, filters before as a mask, bit of the filter) of all orders."""
    found = []
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            found.append((name, step, before, 1 << i))
            before |= 1 << i
    return found


def order_audit(counts: DataFrame, letters: str) -> DataFrame:
    """The audit of every part, order and step from :func:`failure_counts`."""
    n = len(letters)
    full = (1 << n) - 1
    patterns = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("c"))

    def worth(what: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(full)), lambda s: F.aggregate(
            "c", F.lit(0).cast("long"),
            lambda a, x: a + F.when(x["mask"].bitwiseAND(s) != 0, x[what]).otherwise(F.lit(0))))

    games = patterns.select(
        "part", worth("docs").alias("v"), worth("good").alias("v_good"), worth("toxic").alias("v_toxic"),
        F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["docs"]).alias("all_docs"))
    # the arrays are columns of an aggregate's output by here, so the potentials read them as they are
    games = games.select("*", potentials(F.col("v"), n).alias("p"))
    plans = ", ".join(f"struct('{o}', {k}, {s}, {b})" for o, k, s, b in _plans(letters))
    steps = games.select("*", F.explode(F.expr(f"array({plans})")).alias("x")).select(
        "*", F.col("x.col1").alias("filter_order"), F.col("x.col2").alias("step"),
        F.col("x.col3").alias("before"), F.col("x.col4").alias("bit"))

    def lost(game: str) -> Column:
        return F.get(F.col(game), F.col("before") + F.col("bit")) - F.get(F.col(game), F.col("before"))

    return steps.select(
        "part", "filter_order", "step",
        (F.col("all_docs") - F.get("v", F.col("before") + F.col("bit"))).alias("kept"),
        lost("v").alias("removed"),
        (F.get("v", F.col("bit")) - lost("v")).alias("redundant"),
        (F.get("v", F.lit(full)) - F.get("v", F.lit(full) - F.col("bit"))).alias("unique_fails"),
        lost("v_good").alias("good_lost"), lost("v_toxic").alias("toxic_lost"),
        (F.get("p", F.lit(full)) - F.get("p", F.lit(full) - F.col("bit"))).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS,
                 id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, filter order and step: documents kept after the step, removed
    at it, failing its filter but removed before (redundant), failing its filter
    alone (unique_fails), labelled good and toxic ones removed at it, and the
    filter's removals summed over all orders (shapley)."""
    counts = failure_counts(docs, labels, filters, id_col, text_col, part_col)
    return order_audit(counts, "".join(f.letter for f in filters))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Runs every order over every document: the step that removes it is the place
#: of its first failing filter.
ORACLE_OP13 = """
WITH RECURSIVE perms AS (
  SELECT '' AS filter_order UNION ALL
  SELECT p.filter_order || l.x FROM perms p, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) l
  WHERE length(p.filter_order) < 5 AND NOT contains(p.filter_order, l.x)),
orders AS (SELECT filter_order FROM perms WHERE length(filter_order) = 5),
t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part,
         (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS bad
  FROM t),
d AS (
  SELECT f.*, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM f),
r AS (
  SELECT d.*, o.filter_order,
         coalesce((SELECT min(i) FROM range(1, 6) s(i) WHERE contains(bad, substr(o.filter_order, i, 1))), 6) AS gone
  FROM d CROSS JOIN orders o),
s AS (
  SELECT part, filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS letter,
         count(*) FILTER (gone > k) AS kept, count(*) FILTER (gone = k) AS removed,
         count(*) FILTER (gone < k AND contains(bad, substr(filter_order, k, 1))) AS redundant,
         count(*) FILTER (bad = substr(filter_order, k, 1)) AS unique_fails,
         count(*) FILTER (gone = k AND coalesce(good, FALSE)) AS good_lost,
         count(*) FILTER (gone = k AND coalesce(toxic, FALSE)) AS toxic_lost
  FROM r CROSS JOIN range(1, 6) n(k) GROUP BY part, filter_order, k)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM s"""
