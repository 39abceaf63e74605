"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

A text is cut into pieces by the byte-level pattern, and the distinct new pieces
of a block are put into a trie.  The trie is walked depth first; sorted order
is that walk, and the common beginning of neighbours is the path they share.
Each trie node keeps one number: the last token of the encoding of the prefix
that it stands for.  With it the encoding of a prefix is that of a shorter prefix
plus one token, so a node costs a look at the tokens that end there, shared
prefixes are encoded once, and the ids of a word are read off backwards.

The last token of a prefix is the one token t ending there that BPE leaves
beside the last token u of the rest: (u, t) is *stable* if no merge across
their seam comes before the merges that build u and t.  Only tokens on the
right spine of u and the left spine of t ever touch the seam.  A merge (x, y)
of them happens if it precedes the merge that takes x into its parent (that
one is to the left and wins a tie) and does not come after the one that takes
y into its parent.

Encoded pieces are remembered per Python worker, a bounded number of them, and
ids are gathered by array operations for a block of texts.

Defined results: a null text is empty and has no ids; a null id stays null;
repeated rows are encoded one by one.  Strings of special tokens in a text
become those tokens, as the public library does by default.  An empty table
gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import rows_of, table
from inkwell.llm.subwords import PieceTable

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the byte-level pre-tokenization pattern (white space as Unicode has it).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files:
    itself if it is a printable Latin-1 character, else the next one from
    U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieEncoder(PieceTable):
    """Byte-level BPE of one vocabulary file; remembers about ``limit`` pieces
    and verdicts on token pairs."""

    def __init__(self, name: str, limit: int = 350_000):
        super().__init__(limit)
        import public_tokenizers

        with open(public_tokenizers.path(name), encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.ids = {as_bytes(t): i for t, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = [b""] * (1 + max(*vocab.values(), *self.specials.values(), 0))
        for b, i in self.ids.items():
            self.text[i] = b
        for t, i in self.specials.items():
            self.text[i] = t.encode()
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # left, right, rank
        for r, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y = self.ids[as_bytes(a)], self.ids[as_bytes(b)]
            self.rank[x, y] = r
            self.parts.setdefault(self.ids[as_bytes(a + b)], (x, y, r))
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.pieces = regex.compile(PATTERN)
        self.verdicts: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens along one side of the merge tree, each with the rank of the
        merge that takes it into its parent."""
        spine, taken = [], float("inf")
        while True:
            spine.append((token, taken))
            if token not in self.parts:
                return spine
            token, taken = self.parts[token][side], self.parts[token][2]

    def stable(self, left: int, right: int) -> bool:
        pair = left << 20 | right  # one number: no vocabulary is that large
        verdict = self.verdicts.get(pair)
        if verdict is None:
            ours = self._spine(right, 0)
            verdict = True
            for x, x_taken in self._spine(left, 1):
                for y, y_taken in ours:
                    r = self.rank.get((x, y))
                    if r is not None and r < x_taken and r <= y_taken:
                        verdict = False
            if len(self.verdicts) >= self.limit:
                self.verdicts.clear()
            self.verdicts[pair] = verdict
        return verdict

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[int, ...]]:
        """Ids of each of the sorted distinct non-empty ``words``."""
        ids, verdicts, stable = self.ids, self.verdicts, self.stable
        last: list[int] = [-1]  # last token of each prefix on the path; the root has none
        size: list[int] = [0]
        path = b""
        for word in words:
            same, most = 0, min(len(path), len(word))
            if path[:most] == word[:most]:
                same = most
            else:
                while path[same] == word[same]:
                    same += 1
            del last[same + 1:], size[same + 1:]
            for end in range(same + 1, len(word) + 1):
                for begin in range(max(0, end - self.longest), end):
                    token = ids.get(word[begin:end])
                    if token is not None:
                        before = last[begin]
                        if before < 0:
                            ok = True
                        else:
                            ok = verdicts.get(before << 20 | token)
                            if ok is None:
                                ok = stable(before, token)
                        if ok:
                            last.append(token)
                            size.append(end - begin)
                            break
                else:
                    raise ValueError(f"no token of the vocabulary ends at byte {end} of {word!r}")
            path = word
            out, at = [], len(word)
            while at:
                out.append(last[at])
                at -= size[at]
            yield tuple(reversed(out))

    def ids_of(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        order = sorted(range(len(raw)), key=raw.__getitem__)
        found: list[tuple[int, ...]] = [()] * len(raw)
        words = [raw[i] for i in order if raw[i] and new[i] not in self.specials]
        encoded_words = self.encode_words(words)
        for i in order:
            if new[i] in self.specials:
                found[i] = (self.specials[new[i]],)
            elif raw[i]:
                found[i] = next(encoded_words)
        size = np.array([len(f) for f in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, size.sum()), size

    def pieces_of(self, text: str | None) -> list[str]:
        """The pieces of a text, its special tokens among them.  (No piece of
        the pattern is the string of a special token: the text is split at
        those first.)"""
        if not text:
            return []
        if not self.splitter or not any(s in text for s in self.specials):
            return self.pieces.findall(text)
        return [w for p in self.splitter.split(text) for w in ([p] if p in self.specials else self.pieces.findall(p))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        _, ids, bounds = self.look_up([self.pieces_of(t) for t in texts])
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(name: str) -> TrieEncoder:
    """The Python worker's encoder of this vocabulary file."""
    if name not in _ENCODERS:
        _ENCODERS[name] = TrieEncoder(name)
    return _ENCODERS[name]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for block in rows_of(batches, 2_000_000):
            _, flat, bounds = bpe.look_up([bpe.pieces_of(r[1]) for r in block])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in block], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32), pa.int32()))],
                names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``ids_col`` replaced by the text that the ids spell, as
    column ``text``; a null list spells nothing."""
    kept = [c for c in rows.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            lists = batch.column(len(kept))
            flat, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [bpe.decode(flat[a:b].tolist()) for a, b in zip(bounds[at:at + 500], bounds[at + 1:at + 501])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.select(*kept, ids_col).mapInArrow(run, f"{schema}, text string")


def op4_bpe_trie(spark, sf_dir: str) -> DataFrame:
    ids = encoded(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), "ids")
    return decoded(ids).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
