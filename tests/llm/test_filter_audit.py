import math
import random
from itertools import permutations

from helpers import documents, no_labels, odd_documents
from pyspark.sql import functions as F

from inkwell.llm import filter_audit as A

SPACE = " \t\n\x0b\f\r"


def fails(docs):
    """Letters that each row of (doc_id, text, source) fails, by plain code."""
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    found = []
    for i, t, _ in docs:
        t = t or ""
        w, x = "".join(" " if c in SPACE else c for c in t).split(" "), ""
        w = [v for v in w if v]
        x += "A" * (len(w) < 50)
        x += "B" * (100 * len(set(w)) < 65 * len(w))
        x += "C" * (100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t))
        x += "D" * any(c in "#$%&*|" for c in t)
        x += "E" * (i is not None and i > smallest[t])
        found.append(x)
    return found


def brute(docs, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    rows, total = {}, {}
    for (i, _, part), bad in zip(docs, fails(docs)):
        part = part or ""
        for order in permutations("ABCDE"):
            at = next((k for k, x in enumerate(order) if x in bad), 5)
            for k, x in enumerate(order):
                r = rows.setdefault((part, "".join(order), k + 1), [0] * 6)
                r[0] += at > k
                r[1] += at == k
                r[2] += at < k and x in bad
                r[3] += bad == x
                r[4] += at == k and i in good
                r[5] += at == k and i in toxic
                total[part, x] = total.get((part, x), 0) + (at == k)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def audit(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "m", 2) for r in docs], "doc_id long, text string, source string, n long, mask string, part int")
    x = spark.createDataFrame([(*r, "s") for r in labels], "doc_id long, quality int, toxic int, source string")
    got = A.filter_audit(d, x).collect()
    assert len(got) == len({(r.part, r.filter_order, r.step) for r in got})
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley) for r in got}


def test_brute_force_with_odd_rows(spark):
    rng = random.Random(3)
    texts = [None, "", " \n", "A B", "many WORDS " * 40, " ".join(f"w{i}" for i in range(60)),
             " ".join(f"W{i}" for i in range(80)), " ".join(f"w{i % 30} #" for i in range(60)), "x" * 100_000,
             " ".join("ab" for _ in range(70)), "İ É | " * 30, "Ünder fifty"]
    docs = [(i if i % 17 else None, rng.choice(texts), rng.choice(["a", "b", "b", "b", None, ""])) for i in range(150)]
    docs += docs[:9] + [(3, "other text under a used id", "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    assert audit(spark, docs, labels) == brute(docs, labels)


def test_odd_documents_and_empty_tables(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = A.filter_audit(docs, no_labels(spark)).collect()
    want = brute(rows, [])
    assert len(got) == 600 and all(want[r.part, r.filter_order, r.step][1] == r.removed for r in got)
    assert A.filter_audit(documents(spark, []).limit(0), no_labels(spark)).count() == 0


def test_potentials_of_a_game(spark):
    rng = random.Random(8)
    worth = [0, *(rng.randrange(1000) for _ in range(31))]
    got = spark.createDataFrame([(worth,)], "v array<long>").select(A.potentials(F.col("v"), 5).alias("p")).first().p
    for s in range(1, 32):
        own = [i for i in range(5) if s >> i & 1]
        assert len(own) * got[s] == math.factorial(5) * worth[s] + sum(got[s - (1 << i)] for i in own)
    for i in range(5):  # the Shapley value over all orders
        whole = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            whole += worth[before | 1 << i] - worth[before]
        assert got[31] - got[31 - (1 << i)] == whole


def test_values_add_up(spark):
    docs = documents(spark, [(i, f"text {i % 7} " * (10 * (i % 9))) for i in range(100)])
    got = A.filter_audit(docs, no_labels(spark)).collect()
    one = [r for r in got if r.filter_order == "ABCDE"]
    assert sum(r.shapley for r in one) == 120 * sum(r.removed for r in one)
    assert min(r.kept for r in one) + sum(r.removed for r in one) == 100
