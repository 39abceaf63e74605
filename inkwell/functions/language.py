"""Language routing by learned profiles of word endings.

The reference keeps only ``fr``/``en`` of a detection library's answers (anything
else, empty or an error -> ``fr``).  Here a profile of each language is learned
from labelled texts: the frequency of the last three letters of its words (short
words whole), hashed to ``BUCKETS`` places, as log probabilities.  A text gets the
language with the highest sum over all its words (of equals the first by name); a
text without a letter gets ``fr``; then the same two-language mapping applies.
One trigram a word costs a fifth of all trigrams, inside the row.

Learning is one aggregation (partial counts by language and bucket) over all
labelled texts.  A profile is a fixed number of integers, so it is a literal of the
plan: scoring stays inside the row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
#: Weights are log probabilities times this, as integers.
SCALE = 1000
KEPT = ("fr", "en")
FALLBACK = "fr"


@dataclass(frozen=True)
class Profiles:
    """Languages in order of name, and the weight of every bucket in each."""

    languages: tuple[str, ...]
    weights: tuple[tuple[int, ...], ...]


def ending_buckets(text: Column) -> Column:
    """Buckets of the last three letters of the words (runs of letters,
    lower-cased) of ``text``, ``array<int>``."""
    words = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "), " ")
    ends = F.transform(F.array_remove(words, ""), lambda w: F.right(w, F.lit(3)))
    return F.transform(ends, lambda e: ((F.ascii(e) * 961 + F.ascii(F.substring(e, 2, 1)) * 31
                                         + F.ascii(F.substring(e, 3, 1))) % BUCKETS).cast("int"))


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages of the labelled rows of ``docs``, from all of them."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"))
    counts = labelled.select("l", F.explode(ending_buckets(F.col("t"))).alias("b")).groupBy("l", "b").count().collect()
    languages = tuple(sorted({r.l for r in counts}))
    total = {x: sum(r["count"] for r in counts if r.l == x) for x in languages}
    found = {(r.l, r.b): r["count"] for r in counts}
    return Profiles(languages, tuple(tuple(
        round(SCALE * math.log((found.get((x, b), 0) + 0.5) / (total[x] + 0.5 * BUCKETS))) for b in range(BUCKETS))
        for x in languages))


def detect_language(plain_text: Column, profiles: Profiles) -> Column:
    """The language of the whole text by ``profiles``."""
    if not profiles.languages:
        return F.lit(FALLBACK)
    names = F.array(*[F.lit(x) for x in profiles.languages])
    weights = [F.expr(f"array({', '.join(map(str, w))})") for w in profiles.weights]

    def winner(scores: Column) -> Column:
        return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))

    def total(buckets: Column, weight: Column) -> Column:
        return F.aggregate(buckets, F.lit(0).cast("long"), lambda s, b: s + F.get(weight, b))

    def scored(buckets: Column) -> Column:
        scores = F.array(*[total(buckets, w) for w in weights])
        return F.when(F.size(buckets) == 0, F.lit(FALLBACK)).otherwise(F.transform(F.array(scores), winner)[0])

    return F.coalesce(F.transform(F.array(ending_buckets(plain_text)), scored)[0], F.lit(FALLBACK))


def route_language(detected: Column) -> Column:
    """Only ``fr``/``en`` are kept; everything else becomes ``fr``."""
    return F.when(detected.isin(*KEPT), detected).otherwise(F.lit(FALLBACK))
