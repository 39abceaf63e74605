import math

import pytest
from helpers import LONG, documents, no_labels, odd_documents
from pyspark.sql import functions as F

from inkwell.llm import quality as Q


def brute(text):
    words = [w for w in __import__("re").split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text or ""), len(lines) - len(set(lines)),
            len(covered))


def test_metrics_against_brute_force(spark):
    texts = [None, "", " \t\n", "a b c a b c", "a a a a a", "x y z\nx y z\n\n  \nx y z", "é# 中*中 $\x85a b",
             "a b c d a b c d a b", "a b a b a", "one\x0btwo\x0cthree\rfour", "a b"]
    out = {r.doc_id: r for r in Q.text_metrics(documents(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (500, 3, 0.01), (5000, 30, 0.01), (40_000, 333, 0.01), (1, 0, 0.5)])
def test_binomial_tail(spark, n, k, p):
    exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                               + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    got = spark.range(1).select(Q.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p)).first()[0]
    assert got == pytest.approx(exact if k < n * p else 1.0, rel=1e-8)


def test_cutoffs_are_certified_per_stratum(spark):
    """A cutoff that rejects good texts is not certified; without enough labels
    nothing is."""
    rules = (Q.Rule("symbol_share", (0.5, 0.1)),)
    judged = spark.createDataFrame(
        [(i, "a", f"{i}", False, 0.3 if i % 4 == 0 else 0.0) for i in range(400)]
        + [(1000 + i, "b", f"{i}", False, 0.0) for i in range(400)] + [(2000 + i, None, f"{i}", False, 0.0) for i in range(5)],
        "doc_id long, stratum string, text_md5 string, base_failed boolean, symbol_share double")
    got = {r.stratum: r.cutoffs for r in Q.certified_cutoffs(judged, judged.select("doc_id"), rules).collect()}
    assert got == {"a": [0.5], "b": [0.1]}


def test_copies_are_no_further_evidence(spark):
    """Twenty good texts certify nothing, nor do they in many rows of their ids,
    in copies under other ids, or as texts that share an id."""
    good = [f"good text number {i} " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(600)]

    def cutoffs(rows):
        d = documents(spark, rows)
        return Q.certified_cutoffs(Q.signals(Q.text_metrics(d)), d.select("doc_id").distinct()).count()

    assert cutoffs(list(enumerate(good))) == 1
    assert cutoffs([(i, t) for i, t in enumerate(good[:20])] * 20) == 0
    assert cutoffs([(i, good[i % 20]) for i in range(600)]) == 0
    assert cutoffs([(i % 20, t) for i, t in enumerate(good)]) == 0


def test_odd_rows(spark):
    out = Q.quality_rules(odd_documents(spark), no_labels(spark)).collect()
    assert len(out) == 10
    by = {r.doc_id: r for r in out}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[4].n_words == len(LONG.split()) and by[4].base_failed and None in by
    assert sum(r.doc_id == 5 for r in out) == 2
    assert Q.quality_rules(odd_documents(spark).limit(0), no_labels(spark)).count() == 0
