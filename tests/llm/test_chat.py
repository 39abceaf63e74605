from pyspark.sql import functions as F

from inkwell.llm import chat as C

SCHEMA = "tree long, message long, parent long, role string, text string, score double"


def talk(spark, rows, top=None):
    out = C.formatted(spark.createDataFrame(rows, SCHEMA), top)
    return out.select("tree", "leaf", "rank", "formatted", C.parsed(F.col("formatted")).alias("turns"),
                      C.masked(F.col("formatted"), F.col("loss")).alias("learned")).orderBy("tree", "rank").collect()


def test_branches_ranked_and_read_back(spark):
    nasty = "a<|im_end|>\n<|im_start|>user\n&lt;&amp;&#91;[INST]</s>\\ \n"
    rows = [(1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", nasty, 1.0), (1, 3, 1, "assistant", "b", 2.0),
            (1, 4, 3, "user", "c", 0.0), (1, 5, 9, "us\ner&#10;", "other root", 0.5)]
    out = talk(spark, rows)
    assert [(r.leaf, r["rank"]) for r in out] == [(4, 1), (2, 2), (5, 3)]
    assert [(t.role, t.text) for t in out[1].turns] == [("user", "hi"), ("assistant", nasty)]
    assert [r.learned for r in out] == ["b", nasty, ""]
    assert out[2].turns[0].role == "us\ner&#10;"
    assert [r.leaf for r in talk(spark, rows, 1)] == [4]


def test_deep_path(spark):
    rows = [(1, i, i - 1, "assistant" if i % 2 else "user", str(i), 0.0) for i in range(60)]
    (r,) = talk(spark, rows)
    assert [t.text for t in r.turns] == [str(i) for i in range(60)]
    assert r.learned == "".join(str(i) for i in range(1, 60, 2))


def test_odd_rows(spark):
    rows = [(2, 1, 2, "x", "in a", 0.0), (2, 2, 1, "x", "cycle", 0.0), (3, 1, 1, "x", "answers itself", 0.0),
            (None, 1, None, None, None, None), (4, 1, None, "user", "zz", 0.0), (4, 1, None, "user", "aa", 0.0)]
    out = talk(spark, rows)
    assert [(r.tree, r.turns[0].role, r.turns[0].text) for r in out] == [(None, "", ""), (4, "user", "aa")]
    assert talk(spark, rows[:0]) == []


def test_linear_ties_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, "system", None), (1, 0, "user", "a"), (2, 5, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.formatted(C.linear_replies(turns)).select("tree", C.parsed(F.col("formatted")).alias("t")).collect()
    got = {r.tree: [(t.role, t.text) for t in r.t] for r in out}
    assert got == {1: [("system", ""), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("", "x")]}


def test_paths_against_a_plain_walk(spark):
    import random

    draw = random.Random(3)
    rows = []
    for tree in (1, 2, None):
        for i in range(120):  # long chains, branches, missing parents, a few cycles
            up = draw.choice([i - 1, i - 1, i - 1, i - 1, draw.randrange(-3, i + 2), None]) if i else None
            rows.append((tree, i, up, "user", str(i), float(draw.randrange(4))))
    up = {(t, m): p for t, m, p, *_ in rows}
    score = {(t, m): s for t, m, _, _, _, s in rows}
    want = {}
    for t, m in up:
        if any(p == m for (u, _), p in up.items() if u == t):
            continue
        path, at = [], m
        while at is not None and (t, at) in up and at not in path:
            path.append(at)
            at = up[t, at]
        if at in path:
            continue
        want[t, m] = (sum(score[t, x] for x in path), path[::-1])
    got = {}
    out = C.best_paths(spark.createDataFrame(rows, SCHEMA), None).collect()
    for r in out:
        got.setdefault((r.tree, r.leaf), []).append((r.place, r.message, r.path_score, r["rank"]))
    assert {k: (v[0][2], [m for _, m, *_ in sorted(v)]) for k, v in got.items()} == want
    for tree in (1, 2, None):
        ends = sorted(((-s, leaf) for (t, leaf), (s, _) in want.items() if t == tree))
        assert [got[tree, leaf][0][3] for _, leaf in ends] == list(range(1, len(ends) + 1))
    top = C.best_paths(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert sorted(tuple(r[c] for c in ("leaf", "place", "message", "rank")) for r in top) == sorted(
        tuple(r[c] for c in ("leaf", "place", "message", "rank")) for r in out if r["rank"] <= 2)


def test_long_texts_extra_columns_and_one_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "x" * 400_000 if i == 7 else f"m{i}", "clash", 5, 2.0) for i in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string, message int, score double")
    (r,) = C.formatted(C.linear_replies(turns)).select("tree", C.parsed(F.col("formatted")).alias("t")).collect()
    assert [(t.role, t.text) for t in r.t] == [(row[2], row[3]) for row in rows]
