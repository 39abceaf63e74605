import zlib

import numpy as np
from helpers import SMALL, documents, odd_documents

from inkwell.llm import packing as P
from inkwell.llm.subwords import ChunkEncoder


def test_encoder_equals_the_library():
    import random

    enc = ChunkEncoder(P.VOCABULARY, limit=500)
    rng = random.Random(1)
    bits = " \n\t\r\x0b\x85  aabthe'sSll'dé中国🙂́1½!!..-=__ΣİςÅ가" + "ABß"
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b, x.", "\"word\" (word) 'sword word's word' ...word!?", ""]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [ids.tolist() for i in range(0, len(texts), 100) for ids in enc.encode(texts[i:i + 100])]
    assert got == want


def check(rows, texts, room):
    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    want = []
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, s, len(ids[s:s + room]), zlib.crc32(ids[s:s + room].tobytes()))
                 for k, s in enumerate(range(0, len(ids), room))]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= room
    total = sum(r.length for r in rows)
    return len(places), -(-total // room)


def test_small_table(spark):
    rows = P.op2_best_fit_packing(spark, SMALL).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    used, bound = check(rows, texts, P.LENGTH)
    assert used <= bound + 1


def test_several_groups_and_rounds(spark):
    rng = np.random.default_rng(0)
    docs = documents(spark, [(i, "word " * int(rng.integers(1, 90))) for i in range(600)])
    rows = P.packed_sequences(docs, room=64, group=50).collect()
    used, bound = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert used <= bound + 2


def test_odd_rows(spark):
    docs = odd_documents(spark)
    check(P.packed_sequences(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], P.LENGTH)
    assert P.packed_sequences(docs.limit(0)).count() == 0


def test_exchanges_empty_bins():
    # best-fit decreasing needs four bins here, an exchange makes three do
    lengths = np.array([6, 4, 4, 3, 3, 3, 3, 2, 2])
    bins = P.best_fit(lengths, 10)
    better = P.local_search(lengths, bins, 10)
    fill = np.bincount(better, lengths)
    assert fill.max() <= 10 and (fill > 0).sum() == 3
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 100, rng.integers(1, 300))
        bins = P.best_fit(lengths, 100)
        better = P.local_search(lengths, bins, 100)
        fill = np.bincount(better, lengths)
        assert fill.max() <= 100 and (fill > 0).sum() <= len(np.unique(bins))


def fewest(lengths, room):
    """Optimal number of bins, by trying every bin for every piece."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in {s: k for k, s in enumerate(bins) if s + lengths[i] <= room}.values():
            place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_against_the_optimum():
    rng, off, saved = np.random.default_rng(7), 0, 0
    for _ in range(300):
        lengths = np.sort(rng.integers(2, 12, rng.integers(3, 10)))[::-1]
        start = P.best_fit(lengths, 20)
        used = len(np.unique(P.local_search(lengths, start, 20)))
        want = fewest(lengths.tolist(), 20)
        assert want <= used <= len(np.unique(start))
        off, saved = off + (used > want), saved + (len(np.unique(start)) > used)
    assert off <= 3, (off, saved)


def test_rounds_end_and_lose_little(spark):
    """Many small groups, of pieces that fit together badly or are all alike."""
    for lengths in ([int(x) for x in np.random.default_rng(1).integers(1, 64, 900)], [1] * 500, [40] * 300, [64] * 5):
        cut = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
        rows = P.pack(cut, room=64, group=20).collect()
        fill, size = {}, dict(enumerate(lengths))
        for r in rows:
            fill[r.sequence_id] = fill.get(r.sequence_id, 0) + size[r.row]
        assert len(rows) == len(lengths) and max(fill.values()) <= 64
        # groups of 20 pieces hold some ten bins: 471 bins of the first lengths, 454 in one group
        assert len(fill) <= max(-(-sum(lengths) // 64) * 1.05 + 1, sum(x > 32 for x in lengths)), lengths[:3]


def test_bins_tried_in_vain_are_not_searched_again(monkeypatch):
    """Of few pieces a bin, most bins find nothing after every exchange of others:
    the pieces are searched about once for each change of a bin, and the result is
    one that no exchange improves."""
    searched, search = [], P._best_exchange
    monkeypatch.setattr(P, "_best_exchange", lambda *a: searched.append(search(*a)) or searched[-1])
    lengths, room = np.random.default_rng(3).integers(300, 1200, 700), 2048
    bins = P.local_search(lengths, P.best_fit(lengths, room), room)
    fill = np.bincount(bins, lengths).astype(np.int64)
    found = sum(f is not None for f in searched)
    assert found > 100 and len(searched) < 3 * found + len(fill), (found, len(searched), len(fill))
    for donor in np.flatnonzero(fill):
        under = (fill >= fill[donor]) & (fill < room)
        under[donor] = False
        assert fill[donor] == room or not search(np.flatnonzero(bins == donor), donor, lengths, bins, fill, under, room)


def test_masks_are_the_exchanges():
    rng = np.random.default_rng(4)
    for _ in range(200):
        mine, other = (rng.integers(1, 12, rng.integers(1, 5)).tolist() for _ in "ab")
        room = max(sum(mine), sum(other)) + int(rng.integers(0, 4))
        least, gives, _, _ = P._masks(mine, room)
        _, _, spare, takes = P._masks(other, room)
        sums = [*mine, *(a + b for i, a in enumerate(mine) for b in mine[:i])]
        assert spare == room - sum(other) and (least <= spare) == any(a <= spare for a in mine)
        assert bool(gives & takes) == any(q < s <= q + spare for s in sums for q in other)


def test_groups_are_packed_side_by_side(spark, monkeypatch):
    tasks, staged = [], P.staged
    monkeypatch.setattr(P, "staged", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or staged(df, name))
    cut = spark.createDataFrame([(i, 1 + i % 63) for i in range(600)], "row long, length long")
    assert P.pack(cut, room=64, group=100).count() == 600
    assert tasks[0] == 6, tasks
