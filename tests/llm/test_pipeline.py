import os

import corpus_pipeline as CP
from helpers import SMALL, documents


def test_stages_keep_columns_and_drop_what_they_should(spark, tmp_path):
    sf = str(tmp_path)
    for t in ("documents", "labels"):
        os.symlink(f"{SMALL}/{t}.parquet", f"{sf}/{t}.parquet")
    good = " ".join(f"word{i}" for i in range(80))
    near = good + " and a bit more"
    docs = documents(spark, [(1, good), (2, near), (3, good), (3, good), (4, "short"), (5, None), (None, good), (6, "# " * 200)])
    kept = {}
    for name, stage in CP.STAGES[:-1]:
        docs = CP.staged(stage(spark, docs, sf), "test")
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "score" in docs.columns
        kept[name] = sorted(r.doc_id for r in docs.collect())
    assert kept == {"quality_rules": [1, 2, 3, 3], "toxicity": [1, 2, 3, 3], "ngram_jaccard": [1]}
    packed = CP.STAGES[-1][1](spark, docs, sf).collect()
    assert [(r.doc_id, r.piece, r.start, r.offset) for r in packed] == [(1, 0, 0, 0)]
    empty = documents(spark, []).limit(0)
    for _, stage in CP.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in ("first", "second", "third"))
    docs = documents(spark, [(7, a), (7, b), (7, a), (5, b + " more"), (8, c), (8, c + " more"), (8, c)])
    kept = CP.drop_near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r.doc_id, r.text[:5]) for r in kept) == [(5, "secon"), (7, "first"), (8, "third")]


def test_run_covers_the_small_table(spark):
    rows = CP.run(spark, SMALL).collect()
    ids = {r.doc_id for r in rows}
    assert 0 < len(ids) < spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard", "best_fit_packing"]
