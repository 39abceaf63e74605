import numpy as np
from pyspark.sql import functions as F

from inkwell.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, node long, bucket string, code long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], b, 1, "z", 2)
                                  for i, v, b in rows], SCHEMA)


def brute(rows):
    ok = {i: (np.array(v, float), b) for i, v, b in rows}
    n, parent = dict.fromkeys(ok, 0), {i: i for i in ok}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (x, b) in ok.items():
        for j, (y, c) in ok.items():
            if i != j and b == c and x @ y >= E.THRESHOLD * np.sqrt((x @ x) * (y @ y)):
                n[i] += 1
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: (n[i], root(i)) for i in ok}


def test_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows, i = [], 0
    for _ in range(60):
        base = rng.normal(size=64)
        for _ in range(6):
            v = (base + rng.normal(size=64) * 0.1).astype(np.float32)
            rows.append((i, v, i % 2))
            i += 1
    rows += [(1000 + k, rows[0][1], 0) for k in range(5)] + [(2000, rows[0][1] * 2, 0), (2001, rows[0][1], 1)]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(frame(spark, rows)).collect()}
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert there > 300 and 0.9 * there <= found <= there
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(got[k] == want[k] for k in want) >= 0.95 * len(want)


def test_each_pair_is_met_once(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 1 << 62))
    codes = [(k, "a", base ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)))) for k in range(60)]
    codes = [(k, b, c - (1 << 64) if c >= 1 << 63 else c) for k, b, c in codes]
    got = [tuple(r) for r in E.candidates(spark.createDataFrame(codes, "node long, bucket string, code long")).collect()]
    want = {(a, b) for a, _, x in codes for b, _, y in codes if a < b and
            any(bin(((x ^ y) >> 16 * t) & 0xFFFF).count("1") <= 1 for t in range(4))}
    assert sorted(got) == sorted(want)


def test_bits_are_balanced():
    x = np.random.default_rng(2).normal(size=(500, 32)) + 3
    projection, threshold = E.fit_rotation(x)
    on = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ projection >= threshold
    assert np.abs(on.mean(axis=0) - 0.5).max() < 0.02


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [0.0] * 3, 1), (6, [1.0, None, 3.0], 1),
            (7, [float("nan"), 1.0, 1.0], 1), (8, [float("inf"), 1.0, 1.0], 1), (9, [], 1), (None, v, 1), (10, [1.0, 2.0], 1)]
    out = E.near_duplicates(frame(spark, rows)).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    assert len(out) == len(rows) and got[1] == (1, 1, True) and got[2] == (1, 1, False)
    assert all(got[i] == (0, i, True) for i in range(3, 11)) and got[None][:2] == (0, None)
    assert E.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert E.near_duplicates(frame(spark, rows).where(F.col("vec_id") == 5)).collect()[0].n_links == 0
