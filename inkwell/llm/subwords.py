"""Subword ids by a public tokenizer, remembered per white-space chunk.

Only for tokenizers that drop white space, split at it and lower-case (as the
word BPE does): the ids of a text are then those of its chunks in a row.  Chunks
are cut at spaces and line feeds alone; any other white space, special tokens
and normalization inside a chunk are the tokenizer's own business.

A new chunk that is a word of letters with ASCII punctuation before or after it
is put together from its parts, which the tokenizer separates as well; new words
are encoded many in a row and told apart by their word-end tokens.  All other
chunks go to the tokenizer one by one.

A known chunk costs one dictionary look-up; ids are then gathered by array
operations for a whole block of texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from itertools import chain
from unicodedata import is_normalized

import numpy as np

#: ASCII punctuation that may stand beside a word; an apostrophe
#: before letters may begin a contraction, and ``<|`` a special token.
_AFTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
_BEFORE = _AFTER.replace("'", "")
_WORD_END = "</w>"


def _folded(text: str) -> str:
    """The text in lower case, where that comes to the same for the tokenizer:
    not if it would make a special token, depends on the letters around (sigma),
    changes their number, or meets marks that compose."""
    if "<|" in text or "Σ" in text or "İ" in text:
        return text
    lower = text.lower()
    if text.isascii() or is_normalized("NFC", text) and is_normalized("NFC", lower):
        return lower
    return text


class _Index(dict):
    """Number of each chunk, given at first sight; ``fresh`` are the new ones."""

    def __init__(self, chunks=()):
        super().__init__(zip(chunks, range(1 << 62)))
        self.fresh: list = []

    def __missing__(self, chunk) -> int:
        number = self[chunk] = len(self)
        self.fresh.append(chunk)
        return number


class PieceTable:
    """Ids of known pieces (chunks, words) of text, in arrays.  When more than
    ``limit`` pieces are known, those seen once are forgotten, and if need be the
    rarest others; ``epoch`` then changes, as the pieces' numbers do."""

    def __init__(self, limit: int):
        self.limit, self.epoch = limit, 0
        self.index = _Index()
        self.flat = np.zeros(0, np.uint32)
        self.start, self.size, self.used = np.zeros((3, 0), np.int64)

    def ids_of(self, new: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of new pieces in a row, and the number of each one's."""
        raise NotImplementedError

    def _learn(self, new: list) -> None:
        ids, size = self.ids_of(new)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used = np.concatenate([self.used, np.zeros(len(size), np.int64)])
        self.flat = np.concatenate([self.flat, ids])

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and the end of each piece's."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        place = np.repeat(self.start[numbers] - (ends - size), size)
        place += np.arange(len(place))
        return self.flat[place], ends

    def _forget(self) -> None:
        kept = np.flatnonzero(self.used > 1)
        if len(kept) > self.limit // 2:
            kept = np.sort(kept[np.argsort(-self.used[kept], kind="stable")[: self.limit // 2]])
        names = list(self.index)
        self.index = _Index([names[i] for i in kept.tolist()])
        self.flat, ends = self._gathered(kept)
        self.size, self.used = self.size[kept], self.used[kept] // 2
        self.start = ends - self.size
        self.epoch += 1

    def look_up(self, docs: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of documents given as lists of pieces: the number of each piece, all
        ids in a row, and the bounds of the documents' ids."""
        counts = np.array([len(d) for d in docs], np.int64)
        return self.look_up_coded(chain.from_iterable(docs), slice(None), counts)

    def look_up_coded(self, pieces: Iterable, at, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`look_up`, of documents of so many pieces in a row, each given
        by its place ``at`` in ``pieces``."""
        if len(self.index) > self.limit:
            self._forget()
        numbers = np.fromiter(map(self.index.__getitem__, pieces), np.int64)[at]
        if self.index.fresh:
            self._learn(self.index.fresh)
            self.index.fresh = []
        self.used += np.bincount(numbers, minlength=len(self.used))
        ids, ends = self._gathered(numbers)
        return numbers, ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


class ChunkEncoder(PieceTable):
    """Ids of lists of chunks (all ``str``, or all UTF-8 ``bytes``)."""

    def __init__(self, name: str, limit: int = 600_000):
        super().__init__(limit)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_WORD_END)]] = True

    def _encoded(self, words: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters (a thousand in a row) and then of other
        chunks (one by one): all ids in a row, and the number of each one's."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

        def one_by_one(chunks: list[str]) -> None:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
            sizes.append(np.array([len(f) for f in found], np.int64))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, sizes[-1].sum()))

        rows = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        found = self.tokenizer.encode_batch_fast([" ".join(r) for r in rows], add_special_tokens=False)
        for row, e in zip(rows, found):
            own = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[own]) + 1
            if len(ends) == len(row):
                ids.append(own)
                sizes.append(np.diff(ends, prepend=0))
            else:  # normalization has made other words of some
                one_by_one(row)
        one_by_one(others)
        return np.concatenate(ids), np.concatenate(sizes)

    def ids_of(self, new: list) -> tuple[np.ndarray, np.ndarray]:
        texts = [c.decode("utf-8", "surrogatepass") for c in new] if isinstance(new[0], bytes) else new
        parts, counts, others = [], np.ones(len(texts), np.int64), set()
        for i, c in enumerate(texts):
            if not c.isalpha():
                word = c.strip(_BEFORE)
                if not word.isalpha():
                    word = c.rstrip(_AFTER).lstrip(_BEFORE)  # an apostrophe after it
                if word.isalpha() and "<|" not in c:
                    at = c.index(word)
                    before, after = c[:at], c[at + len(word):]
                    others.add(before)
                    others.add(after)
                    parts += (before, word, after)
                    counts[i] = 3
                    continue
                others.add(c)
            parts.append(c)
        words = set(parts) - others
        if any("İ" in w for w in words):  # its lower case has a mark, which punctuation after it would join
            parts, counts, words, others = texts, np.ones(len(texts), np.int64), set(), set(texts)
        in_order = [list(words), list(others)]
        ids, sizes = self._encoded(*in_order)
        number = dict(zip(chain(*in_order), range(1 << 62)))
        which = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        size = np.add.reduceat(sizes[which], np.cumsum(counts) - counts)
        starts = np.cumsum(sizes) - sizes
        taken = sizes[which]
        place = np.repeat(starts[which] - (np.cumsum(taken) - taken), taken)
        place += np.arange(len(place))
        return ids[place], size

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        docs = [_folded(t).replace("\n", " ").split(" ") if t else [] for t in texts]
        _, ids, bounds = self.look_up(docs)
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(name: str, kind: type = str) -> ChunkEncoder:
    """The Python worker's encoder of this vocabulary file, for chunks of
    ``kind``."""
    if (name, kind) not in _ENCODERS:
        _ENCODERS[name, kind] = ChunkEncoder(name)
    return _ENCODERS[name, kind]


def drop_encoders() -> None:
    """Give back the memory of the Python worker's encoders, in a task that has
    no words to encode."""
    _ENCODERS.clear()
