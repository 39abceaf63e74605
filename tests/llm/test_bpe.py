import hashlib
import random

from helpers import documents, odd_documents

from inkwell.llm import bpe as B


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(B.VOCABULARY))


def odd_texts():
    rng = random.Random(1)
    bits = " \n\t\r\x0b\x0c\x1c\x85  aaabbthe'sSll'dé中国🙂́123٣½!!..--==__  \x00﻿İß"
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return out + ["a" * 5000, " " * 300, "=-" * 900, "<|endoftext|><|endoftext|> x", "", "x <|endoftext|>"]


def test_equals_the_library_and_decodes():
    enc, tok, texts = B.TrieEncoder(B.VOCABULARY, limit=1000), library(), odd_texts()
    got = [ids.tolist() for i in range(0, len(texts), 200) for ids in enc.encode(texts[i:i + 200])]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [enc.decode(i) for i in got] == [tok.decode(i, skip_special_tokens=False) for i in want] == texts


def test_broken_byte_sequences_decode_like_the_library():
    enc, tok, rng = B.encoder(B.VOCABULARY), library(), random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert enc.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = B.decoded(B.encoded(docs)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert B.decoded(B.encoded(docs.limit(0))).count() == 0


def test_query_digests(spark, tmp_path):
    documents(spark, list(enumerate(odd_texts()[-40:]))).write.parquet(str(tmp_path / "documents.parquet"))
    tok, texts = library(), odd_texts()[-40:]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in B.op4_bpe_trie(spark, str(tmp_path)).collect():
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(tok.decode(ids, skip_special_tokens=False))
