"""The best source without joining common shingles, against all pairs."""

import random

import pytest

from inkwell.operators import similarity as SIM


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(articles, corpus):
    out = {}
    sets = {i: shingles(t) for i, t in corpus}
    for i, t in articles:
        own = shingles(t)
        shared, source = max(((len(own & s), -j) for j, s in sets.items()), default=(0, 0))
        out[i] = (-source if shared else None, shared, len(own))
    return out


def texts(rng, n, passages):
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages).split()
            a = rng.randint(0, len(p) // 2)
            parts.append(" ".join(p[a:a + rng.randint(5, len(p))]))
        out.append(" ".join(parts + [f"own{rng.randrange(10**9)}"] * 6))
    return out


@pytest.mark.parametrize("rarest", [1, 2, 16])
def test_best_source_equals_all_pairs(spark, rarest):
    rng = random.Random(rarest)
    passages = [" ".join(rng.choices("abcdefghij", k=rng.randint(6, 30))) for _ in range(12)]
    passages += ["one passage that very many of the texts hold in full"] * 12
    articles = list(enumerate(texts(rng, 150, passages))) + [(900, ""), (901, "too short"), (902, "no source has any of these words")]
    corpus = list(enumerate(texts(rng, 120, passages))) + [(500, "short"), (501, passages[0]), (502, passages[0])]
    a = spark.createDataFrame(articles, "article_id int, text string")
    c = spark.createDataFrame(corpus, "source_id int, text string")
    got = {r.article_id: (r.source_id, r.shared, r.article_shingles) for r in SIM.best_source(a, c, rarest=rarest).collect()}
    assert got == brute(articles, corpus)
    assert sum(s > 0 for _, s, _ in got.values()) > 80
    assert SIM.best_source(a, c.limit(0)).where("shared > 0").count() == 0
    assert SIM.best_source(a.limit(0), c).count() == 0
