import random

from helpers import documents, odd_documents

from inkwell.llm import decontam as D
from inkwell.llm.common import text_blocks


def fold(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = c.lower()
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute(docs, items):
    patterns = []
    for i, t in items:
        w = fold(t)
        m = min(10, len(w))
        if i is not None and w:
            patterns += [(w[k:k + m], str(i)) for k in range(len(w) - m + 1)]
    out = []
    for i, t in docs:
        w = fold(t)
        hit, found = set(), set()
        for p, item in patterns:
            for k in range(len(w) - len(p) + 1):
                if w[k:k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(item)
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def search(spark, docs, items, **more):
    x = spark.createDataFrame([(*r, 1, "p") for r in items], "item_id long, text string, places int, items string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in
                   D.contamination(documents(spark, docs), x, **more).collect()), key=str)


def cases():
    rng = random.Random(4)
    words = ["a", "b", "ab", "Ünd", "é1", "7", "ba"]
    texts = [rng.choice([" ", ", ", "\n", "_"]).join(rng.choice(words) for _ in range(rng.randint(0, 60)))
             for _ in range(120)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 10, 11, 12, 30]))))
             for i in range(12)]
    items += [(i, " ".join(fold(rng.choice(texts))[:rng.randint(1, 40)])) for i in range(20, 60)]
    items += [(3, "a second text of item three"), (70, items[5][1]), (None, "a b"), (80, None), (81, "?!")]
    texts += ["x " * 30 + (items[20][1] or "").upper() + " y" * 30, "A SECOND text-of ITEM three!"] * 2
    docs = [(i, t) for i, t in enumerate(texts)] + [(5, None), (None, texts[3]), (9, ""), (9, "")]
    return docs, items


def test_brute_force(spark):
    docs, items = cases()
    want = brute(docs, items)
    assert search(spark, docs, items) == want
    assert sum(r[2] > 0 for r in want) > 50


def test_blocks_of_items_give_the_same(spark):
    docs, items = cases()
    assert len(list(text_blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", 100))) > 5
    assert search(spark, docs, items, block_bytes=100) == brute(docs, items)


def test_long_and_odd_documents(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "wort für wort and word by word wort für wort"), (2, "X" * 50_000), (3, "text")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in D.contamination(docs, items).collect()}
    assert got[4, 140_000].n_hit == 139_996 and got[4, 140_000]["items"] == ["1"]
    assert got[8, 1].n_hit == 1 and got[1, 0].n_hit == 0 and got[None, 4]["items"] == ["3"]
    assert D.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert D.contamination(docs.limit(0), items).count() == 0


def test_shifts_skip_and_never_pass_an_occurrence():
    rng = random.Random(6)
    for _ in range(300):
        m = rng.randint(2, 6)
        p = D.Patterns(m)
        known = [tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(m)) for _ in range(rng.randint(1, 5))]
        for k, w in enumerate(known):
            p.add(w, k)
        p.build()
        text = [rng.choice([b"a", b"b", b"c", b"z"]) for _ in range(rng.randint(0, 60))]
        want = [(i, tuple(text[i:i + m])) for i in range(len(text) - m + 1) if tuple(text[i:i + m]) in known]
        assert sorted(p.search(text)) == want
