import random
from collections import Counter, defaultdict

import numpy as np
from helpers import SMALL, documents, odd_documents

from inkwell.llm import jaccard as J


def brute(texts):
    """Set sizes and components by counting common shingles of all pairs."""
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, k in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def same(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    return got


def test_small_table(spark):
    same(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_copies_near_the_threshold_and_short_texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for size in (3, 5, 7, 8, 9, 10, 12, 14, 20, 40, 90, 200):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, size // 20))):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
            texts.append(" ".join(copy))
    texts += ["W1 w2\tw3\nw4 w5"] * 3 + ["w1 w2 w3 w4 w5", "", " ", "one", "ONE"]
    got = same(spark, documents(spark, list(enumerate(texts))))
    assert len({c for _, c in got.values()}) < 0.7 * len(got)


def test_schemes_lose_no_pair():
    """Any two sets within the allowed difference share a key."""
    rng = np.random.default_rng(0)
    for n in (4, 5, 6, 9, 13, 30, 77, 200, 1000):
        for _ in range(30):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            allowed = J._differences(2 * n)
            drop = int(rng.integers(0, allowed + 1))
            b = a[drop:]
            more = rng.integers(0, 1 << 63, int(rng.integers(0, allowed - drop + 1)), dtype=np.uint64)
            b = np.concatenate([b, more])
            if 100 * (n - drop) < 80 * (n + len(more)) or len(b) < J._LEAST:
                continue
            keys = []
            for s in (a, b):
                bounds = np.array([0, len(s)])
                mine, size = set(), len(s)
                bands = {int(np.searchsorted(J._BANDS, m, "right") - 1) for m in (size, size * 100 // 80)}
                for band in bands:
                    partner = min(size * 100 // 80, J._BANDS[band + 1] - 1)
                    rows, at = np.array([0]), np.array([band])
                    may = np.array([J._differences(size + partner)])
                    for seed in range(J._SEEDS):
                        _, key, again = J._scheme_keys(s, bounds, rows, at, may, seed)
                        mine |= set(key.tolist())
                        if not again[0]:
                            break
                keys.append(mine)
            assert keys[0] & keys[1], (n, drop, len(more))


def test_odd_rows(spark):
    out = J.near_duplicates(odd_documents(spark)).collect()
    assert len(out) == 10
    by = {r.doc_id: r for r in out}
    assert by[1].n_shingles == 0 and by[1].component_id == 1 and by[3].component_id == 3
    assert by[None].component_id is None and by[5].component_id == 5
    assert J.near_duplicates(odd_documents(spark).limit(0)).count() == 0
