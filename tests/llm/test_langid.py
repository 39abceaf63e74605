from collections import Counter
from math import log2

import numpy as np
from helpers import odd_documents

from inkwell.llm import langid as L


def brute_cost(counts, lang, context, byte):
    for k in range(L.ORDER, -1, -1):
        seen = counts.get((lang, context[len(context) - k:]))
        if seen:
            total, kinds = sum(seen.values()), len(seen)
            if byte in seen:
                return log2((total + kinds) / seen[byte])
            if k == 0:
                return log2((total + kinds) / kinds) + 8.0
            return log2((total + kinds) / kinds) + brute_lower(counts, lang, context, byte, k - 1)
    return 8.0


def brute_lower(counts, lang, context, byte, k):
    if k < 0:
        return 8.0
    seen = counts.get((lang, context[len(context) - k:]))
    if not seen:
        return brute_lower(counts, lang, context, byte, k - 1)
    total, kinds = sum(seen.values()), len(seen)
    if byte in seen:
        return log2((total + kinds) / seen[byte])
    return log2((total + kinds) / kinds) + brute_lower(counts, lang, context, byte, k - 1)


def test_code_lengths_are_exact(spark):
    docs = [("a", "abracadabra abra"), ("b", "zzyzx zyzzy"), ("a", "cadab"), ("b", ""), ("a", "ÉÉ x")]
    counts: dict = {}
    for lang, text in docs:
        b = b"\0" * L.ORDER + text.lower().encode()
        for i in range(L.ORDER, len(b)):
            for k in range(L.ORDER + 1):
                counts.setdefault((lang, b[i - k:i]), Counter())[b[i]] += 1
    profiles = L.train(spark.createDataFrame(docs, "lang string, text string"))
    texts = ["abra zyz", "qué?", "x", "cadabra", "zz" * 5000]
    want = []
    for t in texts:
        b = b"\0" * L.ORDER + t.lower().encode()
        want.append([sum(brute_lower(counts, x, b[i - 3:i], b[i], L.ORDER) for i in range(3, len(b))) for x in "ab"])
    rows = spark.createDataFrame([*enumerate(texts), (9, ""), (10, None)], "doc_id long, text string")
    for cells in (L.CELLS, 10, 1):  # all windows, or five or none of them, are sent to the tasks
        got = {r.doc_id: r.bits for r in L.code_lengths(rows, profiles, cells).collect()}
        assert len(got) == 7 and got[9] is None and got[10] is None
        assert np.allclose(np.array([got[i] for i in range(5)]) - profiles.prior, want, rtol=1e-5)


def test_index_finds_every_key():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 32, 5000).astype(np.uint32))
    index = L.Index(keys[::2])
    assert (index.find(keys[::2]) == np.arange(len(keys[::2]))).all()
    assert (index.find(keys[1::2]) == -1).all()
    assert (L.Index(keys[:0]).find(keys[:9]) == -1).all()


def test_a_small_language_keeps_every_context(spark):
    """Beside a language of a hundred times its size, with few windows sent to
    the tasks."""
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), 6))
    text = lambda letters: " ".join(word(letters) for _ in range(40))
    big, small = [text("abcdefghijk") for _ in range(300)], [text("ghijklmnopq") for _ in range(3)]
    profiles = L.train(spark.createDataFrame([("big", t) for t in big] + [("small", t) for t in small], "lang string, text string"))
    want = set()
    for t in small:
        b = b"\0" * L.ORDER + t.encode()
        want |= {int.from_bytes(b[i - 3:i + 1], "big") for i in range(3, len(b))}
    assert {r.gram for r in profiles.counts.where("lang = 'small'").collect()} == want
    docs = spark.createDataFrame(list(enumerate(big[:5] + small)), "doc_id long, text string")
    few, whole = ({r.doc_id: r.bits for r in L.code_lengths(docs, profiles, c).collect()} for c in (200, L.CELLS))
    assert all(np.allclose(few[i], whole[i]) for i in range(8))
    assert [r.lang_pred for r in L.predicted(docs, profiles, cells=200).orderBy("doc_id").collect()] == ["big"] * 5 + ["small"] * 3


def test_odd_rows(spark):
    docs = spark.createDataFrame([("en", "one word and another text"), ("de", "ein Wort für Wort")], "lang string, text string")
    trees = L.train(docs)
    out = {r.doc_id: r for r in L.predicted(odd_documents(spark), trees).collect()}
    assert len(out) == 9 and out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[1].score == 0
    assert out[7].lang_pred == "en" and 0 < out[7].score <= 1 and out[None].lang_pred == "en"
    nothing = L.train(docs.limit(0))
    assert nothing is None
    assert {r.lang_pred for r in L.predicted(odd_documents(spark), nothing).collect()} == {"und"}
    assert L.predicted(odd_documents(spark).limit(0), trees).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in L.op7_ppm_language(spark, sf).collect() if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.99 * len(held)
