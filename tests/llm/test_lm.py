import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL, documents, odd_documents

from inkwell.llm import lm as M
from inkwell.llm.common import ascii_words, coded_words

TINY = M.Settings(sample_docs=50, classes=12, steps=30)


def test_gradient():
    rng = np.random.default_rng(1)
    f = lambda *s: rng.normal(size=s) * 0.3
    m = M.Model(rng.integers(0, 5, M.SIZE), None, f(M.SIZE, 4), f(M.WINDOW, 4), f(4, 12), f(4, 4), f(4, 5), f(5))
    ids, t = rng.integers(0, 50, (3, M.WINDOW)), rng.integers(0, 5, (3, M.WINDOW))
    w = (rng.random((3, M.WINDOW)) > 0.3).astype(float)
    loss, grads = M._gradient(m, ids, t, w)
    for name in ("qkv", "out", "head", "bias", "place"):
        a = getattr(m, name)
        at = tuple(rng.integers(0, s) for s in a.shape)
        a[at] += 1e-5
        assert (M._gradient(m, ids, t, w)[0] - loss) / 1e-5 == pytest.approx(grads[name][at], abs=1e-5)
        a[at] -= 1e-5


def test_gradient_of_both_levels():
    rng = np.random.default_rng(4)
    f = lambda *s: rng.normal(size=s) * 0.3
    m = M.Model(rng.integers(0, 7, M.SIZE), None, f(M.SIZE, 4), f(M.WINDOW, 4), f(4, 12), f(4, 4), f(4, 7), f(7),
                move=f(7, 7), top=f(4, 3), lift=f(3), rise=f(7, 3), slot=rng.permutation(7))
    ids, t = rng.integers(0, 50, (3, M.WINDOW)), rng.integers(0, 7, (3, M.WINDOW))
    w = (rng.random((3, M.WINDOW)) > 0.3).astype(float)
    loss, grads = M._gradient(m, ids, t, w)
    logs, _ = M._forward(m, ids)
    assert np.allclose(np.exp(logs).sum(axis=-1), 1)
    assert loss == pytest.approx(-(np.take_along_axis(logs, t[..., None], -1)[..., 0] * w).sum() / w.sum())
    for name in ("qkv", "out", "head", "bias", "place", "top", "lift"):
        a = getattr(m, name)
        at = tuple(rng.integers(0, s) for s in a.shape)
        a[at] += 1e-5
        assert (M._gradient(m, ids, t, w)[0] - loss) / 1e-5 == pytest.approx(grads[name][at], abs=1e-5)
        a[at] -= 1e-5


def test_groups_hold_classes_that_follow_alike():
    rng = np.random.default_rng(5)
    kinds = rng.permutation(np.repeat(np.arange(4), 4))
    order = M.grouped(rng.normal(size=(50, 4))[:, kinds] + 0.01 * rng.normal(size=(50, 16)), 4)
    assert sorted(order.tolist()) == list(range(16))
    assert all(len(set(kinds[order[i:i + 4]])) == 1 for i in range(0, 16, 4))
    assert sorted(M.grouped(rng.normal(size=(5, 7)), 3).tolist()) == list(range(7))


def test_model_is_not_shrunk():
    """Every place of a later window sees eight earlier ids or more."""
    assert (M.WINDOW, M.STEP, M.Settings().classes) == (32, 24, 256)
    _, _, of = M.windows_of([np.arange(500)])
    assert (of[1:] >= 0).argmax(axis=1).min() == 8


def model():
    rng = np.random.default_rng(0)
    docs = [np.append(rng.integers(0, 300, rng.integers(1, 200)), M.END) for _ in range(40)]
    counts = np.bincount(np.concatenate(docs), minlength=M.SIZE).astype(float)
    return M.fit(docs, counts, TINY), docs


def test_each_token_once_and_causal():
    m, docs = model()
    _, targets, of = M.windows_of(docs)
    for i, d in enumerate(docs):
        assert sorted(targets[of == i].tolist()) == sorted(d.tolist())
    scorer = M.Scorer(m)
    inputs = np.random.default_rng(2).integers(0, 300, (1, M.WINDOW))
    logs = scorer.logs(inputs, inputs, 0)
    changed = inputs.copy()
    changed[0, 20:] += 1
    assert np.allclose(scorer.logs(changed, inputs, 0)[0, :20], logs[0, :20])


def test_next_token_distribution_sums_to_one():
    m, _ = model()
    scorer = M.Scorer(m)
    inputs = np.repeat(np.random.default_rng(3).integers(0, 300, (1, M.WINDOW)), 200, axis=0)
    total = 0.0
    for a in range(0, M.SIZE, 200):
        targets = np.repeat(np.arange(a, min(a + 200, M.SIZE))[:, None], M.WINDOW, axis=1)
        total += np.exp(scorer.logs(inputs[:len(targets)], targets, M.WINDOW - 1)).sum()
    assert total == pytest.approx(1.0, abs=1e-3)


def test_scorer_equals_training_forward():
    m, docs = model()
    inputs, targets, of = M.windows_of(docs)
    logits, _ = M._forward(m, inputs)
    p = np.exp(logits - logits.max(axis=-1, keepdims=True))
    p /= p.sum(axis=-1, keepdims=True)
    logs = np.log(np.take_along_axis(p, m.of[targets][..., None], -1)[..., 0]) + m.share[targets]
    want = [logs[of == i].sum() for i in range(len(docs))]
    assert np.allclose(M.Scorer(m).score(docs), want, rtol=1e-4)


def test_base_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    docs = documents(spark, rows)
    learned = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    some = docs.where(docs.doc_id.isin(learned)).select("doc_id", "text")
    m, base, words = M.train(some, M.Settings(sample_docs=50, classes=12, steps=30, head_words=50))
    assert 0 < len(base.head) <= 100  # the rest goes through the join
    c = Counter()
    for i, t in rows:
        if i in set(learned):
            c.update([*t.encode().lower().split(), None])
    z = sum(c.values()) + 0.5 * (len(c) + 1)
    out = {r.doc_id: r for r in M.scored(docs, m, base, words).collect()}
    assert base.tokens == sum(c.values()) and len(out) == len(rows)
    for i, t in rows:
        tokens = [*t.encode().lower().split(), None]
        assert out[i].n_tokens == len(tokens) and out[i].n_known == sum(c[w] > 0 for w in tokens)
        assert out[i].base_score == pytest.approx(sum(np.log10((c[w] + 0.5) / z) for w in tokens))
        assert out[i].score < 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    m, base, words = M.train(docs.select("doc_id", "text"), TINY)
    out = M.scored(docs, m, base, words).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 10 and by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1
    assert by[1].score == by[2].score and all(np.isfinite(r.score) for r in out)
    m, base, words = M.train(docs.select("doc_id", "text").limit(0), TINY)
    assert all(np.isfinite(r.score) and r.n_known == 0 for r in M.scored(docs, m, base, words).collect())
    assert M.scored(docs.limit(0), m, base, words).count() == 0


def test_statistics_are_of_whole_texts_and_all_documents(spark):
    """Pairs and classes know what stands late in a long text, and windows are
    drawn from there."""
    texts = [(i, "alpha beta gamma " * 20) for i in range(30)] + [(99, "plain words " * 3000 + "zebra quartz " * 3000)]
    docs = documents(spark, texts).select("doc_id", "text")
    ids = M.subwords([M.ascii_words(t) for _, t in texts])[1]
    want = Counter()
    for d in ids:
        want.update(zip([M.BEGIN, *d.tolist()[:-1]], d.tolist()))
    _, base, _ = M.statistics(docs)
    rows = M.encoded(docs, base).select("doc_id", "ids").mapInArrow(M._gather(1 << 40), M._GATHERED).collect()
    got = Counter()
    for r in rows:
        if r.window is None:
            got[r.left, r.right] += r.n
    assert got == want
    late = M.subwords([[b"zebra"]])[1][0][0]
    drawn = [np.frombuffer(r.window, np.uint16).reshape(2, -1) for r in rows if r.window is not None]
    assert len(drawn) == len(M.windows_of(ids)[0]) and any((w[1] == late).any() for w in drawn)
    m, _, _ = M.train(docs, M.Settings(sample_docs=1, doc_windows=10, classes=12, steps=5))
    assert m.of[late] != 11  # 11: ids that never occur
    counts = np.bincount(np.concatenate(ids), minlength=M.SIZE).astype(float)
    assert (m.of == M.fit(ids, counts, M.Settings(classes=12, steps=1)).of).all()


def test_all_texts_are_learned_from(spark):
    """Ids that no drawn window holds are learned; equal texts and other
    partitions make the same model."""
    texts = [(i, f"{w} {w} alpha {w} beta") for i, w in enumerate(["zebra", "quartz", "river", "stone", "cloud", "paper"] * 5)]
    docs = documents(spark, [*texts, (None, "without an id"), (99, "")]).select("doc_id", "text")
    few = M.Settings(sample_docs=1, doc_windows=1, classes=12, steps=5, rounds=2, shard=100)
    m, _, _ = M.train(docs, few)
    start = (np.random.default_rng(0).normal(size=(M.SIZE, few.width)) * 0.1).astype(np.float32)
    ids = M.subwords([M.ascii_words(t) for _, t in texts])[1]
    met = np.unique(np.concatenate([d[:-1] for d in ids]))  # all but the end are followed by an id
    assert (m.embed[met] != start[met]).any(axis=1).all()
    again, _, _ = M.train(docs.repartition(5), few)
    assert np.allclose(again.embed, m.embed, atol=1e-6) and np.allclose(again.head, m.head, atol=1e-6)


def test_learned_is_the_mean_by_weight(spark):
    m, docs = model()
    settings = M.Settings(classes=12, large=8)
    rows = [(np.concatenate(docs[a:b]).astype("<u2").tobytes(),) for a, b in ((0, 15), (15, 40))]
    run = M._descend(m, 0.01, settings)
    parts = [b for r in rows for b in run(spark.createDataFrame([r], "ids binary").toArrow().to_batches())]
    sums = next(M._summed(iter(parts))).to_pylist()
    assert sorted(r["part"] for r in sums) == list(range(-1, M._PARTS))
    windows = [-(-len(r[0]) // 2 // M.WINDOW) for r in rows]
    assert np.frombuffer(next(r["weight"] for r in sums if r["part"] == -1))[0] == sum(windows)
    met = np.concatenate([np.frombuffer(r["weight"]) for r in sorted(sums, key=lambda r: r["part"])[1:]])
    assert met[M.BEGIN] == 2 and met.sum() == sum(windows) * M.WINDOW


def test_task_of_few_ids_tells_of_few(spark):
    """What a task sends of the embeddings grows with its ids, not with the
    vocabulary, and the others keep theirs."""
    m, docs = model()
    ids = pa.RecordBatch.from_arrays([pa.array([docs[0].astype("<u2").tobytes()], pa.binary())], names=["ids"])
    parts = list(M._descend(m, 0.01, M.Settings(classes=12))(iter([ids])))
    assert sum(b.nbytes for b in parts) < 100 * len(docs[0]) + 20_000
    sums = {r["part"]: r for r in next(M._summed(iter(parts))).to_pylist()}
    met = np.concatenate([np.frombuffer(sums[i]["weight"]) for i in range(M._PARTS)])
    assert set(np.flatnonzero(met)) <= {M.BEGIN, *docs[0].tolist()} and len(met) == M.SIZE
    total = np.concatenate([np.frombuffer(sums[i]["value"]) for i in range(M._PARTS)]).reshape(M.SIZE, -1)
    assert (total[met == 0] == 0).all() and (total[met > 0] != 0).any(axis=1).all()


def test_coded_words():
    texts = ["", None, " \t\n", " A\x1cB \u00c9\x0bx ", "x  y\n\nx", "one", "\x00 a\u00a0b\x85c"]
    array = pa.array([t and t.encode() for t in texts], pa.binary())
    for a in (array, array.slice(3), array.slice(1, 2), array.slice(0, 0)):
        words, at, size = coded_words(a)
        found = iter([words[i].as_py() for i in at])
        assert [[next(found) for _ in range(n)] for n in size] == [ascii_words(t.as_py()) for t in a]
        assert next(found, None) is None


def test_encoded_ids_are_those_of_the_encoder(spark):
    texts = [(1, "Alpha beta, gamma"), (2, None), (3, " "), (None, "zebra  zebra\n"), (5, "quartz " * 50)]
    _, base, _ = M.statistics(documents(spark, texts))
    rows = {r.doc_id: r for r in M.encoded(documents(spark, texts), base).collect()}
    for i, t in texts:
        words = M.ascii_words(t)
        assert M._ids(rows[i].ids).tolist() == M.subwords([words])[1][0].tolist() and rows[i].n_tokens == len(words) + 1
