import math
import random
from collections import Counter

import numpy as np
from helpers import documents, odd_documents

from inkwell.llm import search as S
from inkwell.llm.common import text_blocks


def terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    queries = {}
    for i, t in items:
        if i is not None:
            queries.setdefault(i, set()).update(terms(t))
    out = []
    for item, q in queries.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + 50 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in q if t in c)
            if s > 0:
                scored.append((-s, math.inf if i is None else i))
        out += [(str(item), r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k, **more):
    d = documents(spark, docs).repartition(4)
    x = spark.createDataFrame([(*r, 1, "p") for r in items], "item_id long, text string, rank int, score string")
    return sorted((tuple(r) for r in S.search(S.build_index(d), x, k, **more).collect()), key=str)


def cases(seed=1, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "ß2", "Aa", "b_c"]
    many = [1 / (i + 1) for i in range(len(words))]
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choices(words, many, k=rng.choice([0, 1, 5, 40, 300])))
             for _ in range(n)]
    texts += ["w3 " * 400, "w3 w3 " * 150 + "w150", texts[7], texts[7], "?!", None]
    docs = list(enumerate(texts)) + [(None, texts[3]), (None, "w3 w9"), (2, texts[2]), (2, texts[2])]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 8, 30])))) for i in range(12)]
    items += [(3, "w1 w199"), (50, "w3"), (51, ""), (52, None), (53, "unknownword"), (None, "w1"), (54, "W3 w3 unknownword")]
    return docs, items


def test_brute_force(spark):
    docs, items = cases()
    want = brute(docs, items, 7)
    assert found(spark, docs, items, 7) == want and len(want) > 70


def test_more_than_all_documents_and_blocks_of_queries(spark):
    docs, items = cases(2, 60)
    assert found(spark, docs, items, 1000) == brute(docs, items, 1000)
    assert len(list(text_blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", 120))) > 3
    assert found(spark, docs, items, 5, block_bytes=120) == brute(docs, items, 5)


def test_ties_go_by_id_over_many_tasks(spark):
    docs = [(i, "same text here") for i in range(300, 0, -1)] + [(900, "same")]
    got = found(spark, docs, [(1, "same here")], 20)
    assert got == brute(docs, [(1, "same here")], 20)
    assert sorted(r[2] for r in got) == list(range(1, 21))


def test_bounds_are_never_below_scores():
    rng = random.Random(5)
    words = [f"t{i}".encode() for i in range(500)]
    counts = [Counter(rng.choices(words[:rng.randint(1, 500)], k=rng.choice([1, 20, 900, 5000]))) for _ in range(120)]
    block = S.Queries([(str(i), " ".join(w.decode() for w in rng.sample(words, rng.randint(1, 60)))) for i in range(20)])
    df = Counter(t for c in counts for t in c)
    block.weigh(len(counts), sum(c.total() for c in counts), df)
    norms = block.norms([c.total() for c in counts])
    bounds = block.bounds([S.sketch(c) for c in counts], norms)
    exact = np.array([[block.score(q, c, int(m)) for q in range(20)] for c, m in zip(counts, norms)])
    assert (bounds >= exact).all() and (bounds < 1.3 * exact + 2).mean() > 0.5


def test_odd_documents_and_empty_tables(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "text word 中国 🙂"), (2, "x" * 50_000)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in S.search(S.build_index(docs), items, 9).collect()), key=str)
    assert got == brute(rows, [tuple(r) for r in items.collect()], 9) and got
    assert S.search(S.build_index(docs), items.limit(0)).count() == 0
    assert S.search(S.build_index(docs.limit(0)), items).count() == 0
