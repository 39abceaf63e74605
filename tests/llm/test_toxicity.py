import itertools

import numpy as np
import pytest
from helpers import documents, no_labels, odd_documents

from inkwell.llm import toxicity as X


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    n = 9
    u, first = rng.normal(size=n) * 2, np.zeros(n, bool)
    first[[0, 4, 5]] = True
    start, move = rng.normal(size=2), rng.normal(size=(2, 2))
    p, z, pairs = np.zeros(n), 0.0, np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(u[t] * y[t] + (start[y[t]] if first[t] else move[y[t - 1], y[t]]) for t in range(n)))
        z, p = z + w, p + w * np.array(y)
        for t in range(1, n):
            if not first[t]:
                pairs[y[t - 1], y[t]] += w
    got, transitions = X._expected(u, first, start, move, block=4)
    assert np.allclose(got, p / z) and np.allclose(transitions, pairs / z)
    assert np.allclose(X.marginals(u, first, start, move), p / z)


def test_lanes_do_not_matter():
    rng = np.random.default_rng(1)
    u, move = rng.normal(size=1000) * 5, rng.normal(size=(2, 2))
    first = np.zeros(1000, bool)
    first[[0, 300]] = True
    whole = X.marginals(u, first, np.zeros(2), move)
    apart = np.concatenate([X.marginals(part, f, np.zeros(2), move) for part, f in
                            ((u[:300], first[:300]), (u[300:], first[300:]))])
    assert np.allclose(whole, apart)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    plain = ["river", "stone", "cloud", "table", "window", "garden", "paper", "music", "winter", "bread"]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, 40))
        if i % 4 == 0:
            for at in rng.integers(0, 40, 5):
                words[at] = str(rng.choice(["vilescum", "Snarkel", "gruntlump"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0), "x"))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")


def test_learns_and_points(spark, corpus):
    docs, labels = corpus
    out = {r.doc_id: r for r in X.toxicity(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sum((out[i].score >= 0.5) == (i % 4 == 0) for i in out) >= 398
    for i in range(0, 40, 4):
        said = " ".join(texts[i][s.start:s.end] for s in out[i].spans)
        assert said and set(said.lower().split()) <= {"vilescum", "snarkel", "gruntlump"}


def test_odd_rows(spark, corpus):
    _, labels = corpus
    field = X.fit(X.training_rows(corpus[0], labels))
    out = X.score(odd_documents(spark), field).collect()
    assert len(out) == 10 and all(0 <= r.score < 0.5 for r in out)
    assert X.toxicity(odd_documents(spark), no_labels(spark)).where("score <> 0").count() == 0
    assert X.toxicity(odd_documents(spark).limit(0), labels).count() == 0


def test_copied_documents_push_out_no_mark(spark):
    """Words of toxic copies outnumber 5000 candidates of larger significance;
    the rarer mark of many families stays, the copied words go."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    copied = " ".join("".join(w) for w in rng.choice(letters, (3000, 8)))
    word = lambda: "".join(rng.choice(letters, 9))
    rows = [(1, copied)] * 60
    rows += [(1, " ".join([*(word() for _ in range(9)), "vilescum"])) for _ in range(30)]
    rows += [(0, " ".join(word() for _ in range(10))) for _ in range(400)]
    train = spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(rows)], "doc_id long, toxic int, text string")
    marks = X.toxic_marks(train, X.Settings())
    assert "vilescum" in marks and not marks & set(copied.split())
