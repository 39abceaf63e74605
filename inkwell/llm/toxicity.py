"""Toxicity with a linear-chain conditional random field over tokens.

Only documents are labelled, so token labels are derived first.  Over *all*
training documents, words and word beginnings (an insult is often inflected)
are counted by class; one of them is a toxic candidate when its log-odds for
toxic documents are large and significant, and it becomes a toxic mark when it
also occurs in enough *families* of toxic documents.  A family is the
documents that share the least hash of their word sets; copies of one toxic
document mostly share it, and would otherwise make every rare word of theirs
toxic.  A token is labelled toxic if it bears a toxic mark in a toxic document.

The field has two states.  Its potentials are a weight per word and word
beginning, a bias, and transitions; forward-backward gives each token's marginal.  Four sums over the
marginals feed a logistic score per document.  Both are fitted in numpy on a
bounded sample of the training documents (``sample_docs`` per class, chosen by
a hash of the id), the counts on all of them.

Scoring reads whole texts in blocks of tokens.  A block is one chain in which
every document start forgets the state before it; the chain is cut into short
lanes whose 2x2 transfer products are taken side by side, so that a long text
costs no more per token than many short ones.

Defined results: a null or empty text has no tokens and gets the score of a
document without toxic tokens; a null id is scored and never used in training;
repeated rows are scored one by one; a labelled id counts once, as toxic if
any of its labels says so.  With no toxic or no clean training document the
score is 0 for all.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import hash_sample, id_remainder, rows_of, small, staged, table

_TOKEN = re.compile(r"[^\W\d_]+")
_LANE = 64


@dataclass(frozen=True)
class Settings:
    """Bounds of the training."""

    min_g: float = 15.0  # significance: log-likelihood ratio (chi square, 1 degree)
    min_odds: float = 2.0  # log-odds for toxic documents
    min_families: int = 3  # families of toxic documents with a toxic mark ...
    least_share: float = 0.1  # ... and their share of the commonest mark's
    sample_docs: int = 600  # documents of each class the field is fitted on, about
    features: int = 50_000  # words and beginnings with a weight of their own; toxic marks all have one
    steps: int = 40


@dataclass
class Field:
    """weight: of each word and beginning for the toxic state against the other;
    bias: of every token; start, move: log transitions; judge: of the document."""

    weight: dict[str, float]
    bias: float
    start: np.ndarray
    move: np.ndarray
    judge: np.ndarray


def tokens_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased (after they are found, so that a token's
    place in the text is known)."""
    found = _TOKEN.findall(text) if text else []
    return " ".join(found).lower().split(" ") if found else []


def marks_of(word: str) -> list[str]:
    """The word, and its proper beginnings of 3 to 6 letters with a hyphen."""
    return [word, *(word[:k] + "-" for k in range(3, min(7, len(word))))]


def marks_in(words: set[str]) -> set[str]:
    marks = set(words)
    for k in range(3, 7):
        marks.update(w[:k] + "-" for w in words if len(w) > k)
    return marks


# ---- forward-backward -------------------------------------------------------

def _potentials(unary: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Transfer potentials (00, 01, 10, 11; token) of a chain, padded to whole
    lanes with the identity, and scaled so that no product overflows."""
    n = len(unary)
    out = np.zeros((4, -(-n // _LANE) * _LANE))
    out[0, n:] = out[3, n:] = 1.0
    clean, toxic = np.exp(np.minimum(-unary, 0.0)), np.exp(np.minimum(unary, 0.0))
    e = np.exp(move - move.max())
    s = np.exp(start - start.max())
    for before in (0, 1):
        out[2 * before, :n] = np.where(first, s[0], e[before, 0]) * clean
        out[2 * before + 1, :n] = np.where(first, s[1], e[before, 1]) * toxic
    return out


def marginals(unary: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(toxic) of each token of a chain of documents.  ``first`` marks the
    tokens that begin a document."""
    return _messages(unary, first, start, move)[0]


def _messages(unary, first, start, move) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals, forward messages (state, token) and transfer potentials."""
    n = len(unary)
    flat = _potentials(unary, first, start, move)
    if not n:
        return np.zeros(0), np.zeros((2, 0)), flat
    m = np.ascontiguousarray(flat.reshape(4, -1, _LANE).transpose(0, 2, 1))  # potential, step, lane
    lanes = m.shape[2]
    a, b, c, d = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(_LANE):
        w, x, y, z = m[:, t]
        a, b, c, d = a * w + b * y, a * x + b * z, c * w + d * y, c * x + d * z
        scale = 1.0 / (a + b + c + d)
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
    # states at the lanes' ends, one lane after the other
    begin, end = np.empty((2, lanes)), np.empty((2, lanes))
    p, q = 0.5, 0.5
    across = list(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist()))
    for i, (w, x, y, z) in enumerate(across):
        begin[0, i], begin[1, i] = p, q
        p, q = p * w + q * y, p * x + q * z
        p, q = p / (p + q), q / (p + q)
    p, q = 0.5, 0.5
    for i in range(lanes - 1, -1, -1):
        end[0, i], end[1, i] = p, q
        w, x, y, z = across[i]
        p, q = w * p + x * q, y * p + z * q
        p, q = p / (p + q), q / (p + q)
    before, after = np.empty((2, _LANE, lanes)), np.empty((2, _LANE, lanes))
    p, q = begin
    for t in range(_LANE):
        w, x, y, z = m[:, t]
        p, q = p * w + q * y, p * x + q * z
        scale = 1.0 / (p + q)
        p, q = p * scale, q * scale
        before[0, t], before[1, t] = p, q
    p, q = end
    for t in range(_LANE - 1, -1, -1):
        after[0, t], after[1, t] = p, q
        w, x, y, z = m[:, t]
        p, q = w * p + x * q, y * p + z * q
        scale = 1.0 / (p + q)
        p, q = p * scale, q * scale
    both = before * after
    share = both[1] / (both[0] + both[1])
    return share.T.reshape(-1)[:n], before.transpose(0, 2, 1).reshape(2, -1)[:, :n], flat


def _pairs(first: np.ndarray, p: np.ndarray, before: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected transitions (2, 2) between tokens of the same document, from
    forward messages and the marginals of the next token."""
    n = len(p)
    joint = before[:, None, :-1] * m[:, 1:n].reshape(2, 2, n - 1)  # earlier, later state
    given = joint / joint.sum(axis=0)  # of the earlier state, by the later one
    later = np.stack([1 - p[1:], p[1:]])
    return (given * later)[:, :, ~first[1:]].sum(axis=2)


def _expected(unary, first, start, move, block: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of a long chain and its expected transitions, in blocks of
    whole documents of about ``block`` tokens."""
    p, pairs = np.empty(len(unary)), np.zeros((2, 2))
    begins = np.append(np.flatnonzero(first), len(unary))
    at = 0
    while at < len(unary):
        to = begins[min(np.searchsorted(begins, at + block), len(begins) - 1)]
        p[at:to], before, m = _messages(unary[at:to], first[at:to], start, move)
        pairs += _pairs(first[at:to], p[at:to], before, m)
        at = to
    return p, pairs


# ---- training ---------------------------------------------------------------

def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that contain a mark, counted per task and handed
    on whenever the counter has grown large."""
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        items = list(seen.items())
        seen.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([k[1] for k, _ in items], pa.string()), pa.array([k[0] for k, _ in items], pa.int32()),
             pa.array([v for _, v in items], pa.int64())], names=["word", "toxic", "docs"])

    for block in rows_of(batches):
        for toxic, text in block:
            seen.update((toxic, w) for w in marks_in(set(tokens_of(text))))
        if len(seen) > 300_000:
            yield flush()
    if seen:
        yield flush()


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, family) of every mark of every text, once a block."""
    for block in rows_of(batches):
        found = set()
        for (text,) in block:
            tokens = tokens_of(text)
            if tokens:
                family = min(zlib.crc32(f"{a} {b}".encode("utf-8", "surrogatepass"))
                             for a, b in zip(tokens, [*tokens[1:], ""]))
                found.update((w, family) for w in marks_in(set(tokens)))
        items = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in items], pa.string()), pa.array([c for _, c in items], pa.int64())],
            names=["word", "family"])


def toxic_marks(train: DataFrame, settings: Settings) -> set[str]:
    """Toxic marks from the whole of ``train`` (doc_id, toxic, text).
    Candidates stay on Spark, however many copied documents make; only words
    with enough families reach the driver."""
    totals = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return set()
    words = (
        train.select("toxic", "text").mapInArrow(_class_counts, "word string, toxic int, docs long")
        .groupBy("word").agg(
            F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("docs"))), F.lit(0)).alias("p"),
            F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("docs"))), F.lit(0)).alias("q")))
    p, q = F.col("p").cast("double"), F.col("q").cast("double")
    odds = F.log((p + 0.5) / (pos + 1.0)) - F.log((q + 0.5) / (neg + 1.0))
    rate = (p + q) / float(pos + neg)
    g = 2 * (p * F.log(p / (rate * pos)) + F.when(q > 0, q * F.log(q / (rate * neg))).otherwise(F.lit(0.0)))
    found = words.where("p > 0").select("word", odds.alias("odds"), g.alias("g")) \
        .where((F.col("odds") >= settings.min_odds) & (F.col("g") >= settings.min_g))
    apart = staged(
        train.where("toxic = 1").select("text").mapInArrow(_families, "word string, family long")
        .join(found.select("word"), "word", "left_semi").distinct()
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")), "families")
    most = apart.agg(F.max("n")).first()[0] or 0
    enough = max(settings.min_families, settings.least_share * most)
    return {r["word"] for r in apart.where(F.col("n") >= enough).select("word").collect()}


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the classes weigh alike."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (weight * (y - p)) - ridge * w)
        w = w + np.clip(step, -2, 2)
    return w


def _sums(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document: a constant, log(1 + toxic mass), its share, the largest
    marginal, and the noisy-or.  Marginals count from a quarter on, so that the
    many tokens of a long text that are hardly toxic add nothing."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    out = np.zeros((n, 5))
    out[:, 0] = 1.0
    full = np.flatnonzero(sizes)
    if len(full):
        at = bounds[full]
        p = np.maximum(0.0, (p - 0.25) / 0.75)
        total = np.add.reduceat(p, at)
        out[full, 1] = np.log1p(total)
        out[full, 2] = np.minimum(1.0, 20 * total / sizes[full])
        out[full, 3] = np.maximum.reduceat(p, at)
        out[full, 4] = -np.expm1(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), at))
    return out


def _starts(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Of documents in a row: which tokens begin one, and the bounds."""
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    first = np.zeros(bounds[-1], bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return first, bounds


def fit(train: DataFrame, settings: Settings = Settings()) -> Field | None:
    """A field from ``train`` (doc_id, toxic, text), or None if one class is
    missing."""
    toxic = toxic_marks(train, settings)
    sample = []
    for c in (0, 1):
        chosen = hash_sample(train.where(F.col("toxic") == c), "doc_id", settings.sample_docs)
        sample += chosen.select("doc_id", "toxic", "text").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    labels = np.array([r["toxic"] for r in sample])
    if not toxic or len(set(labels.tolist())) < 2:
        return None
    docs = [tokens_of(r["text"]) for r in sample]
    common = Counter(m for d in docs for m in marks_in(set(d)))
    known = [*sorted(toxic), *(m for m, c in common.most_common(settings.features) if c > 1 and m not in toxic)]
    marks = {m: i + 1 for i, m in enumerate(known[: max(settings.features, len(toxic))])}
    types = {w: i for i, w in enumerate({w: 0 for d in docs for w in d})}
    ids = np.fromiter((types[w] for d in docs for w in d), np.int64, sum(map(len, docs)))
    borne = np.zeros((len(types), 5), np.int64)  # 0: no mark with a weight
    for w, i in types.items():
        own = [marks.get(m, 0) for m in marks_of(w)]
        borne[i, : len(own)] = own
    first, bounds = _starts(docs)
    bad = np.zeros(len(marks) + 1, bool)
    bad[[marks[m] for m in toxic]] = True
    y = bad[borne].any(axis=1)[ids] & (np.repeat(labels, np.diff(bounds)) == 1)
    n_docs, n_marks, n_types = len(docs), len(marks) + 1, len(types)
    del docs, common, types, sample
    weight, bias, start = np.zeros(n_marks), -4.0, np.zeros(2)
    move, gold = np.zeros((2, 2)), np.zeros((2, 2))
    inner = ~first[1:]
    np.add.at(gold, (y[:-1][inner].astype(int), y[1:][inner].astype(int)), 1)
    sq = np.full(n_marks, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    rate, ridge = 1.0, 1e-4
    for _ in range(settings.steps):
        unary = weight[borne].sum(axis=1)[ids] + bias
        p, pairs = _expected(unary, first, start, move)
        gap = y - p
        by_type = np.bincount(ids, gap, n_types)
        g_mark = np.bincount(borne.ravel(), np.repeat(by_type, borne.shape[1]), n_marks) / n_docs - ridge * weight
        g_mark[0] = 0.0
        g_bias = gap.sum() / n_docs - ridge * bias
        g_move = (gold - pairs) / n_docs - ridge * move
        sq = sq[0] + g_mark**2, sq[1] + g_bias**2, sq[2] + g_move**2
        weight = weight + rate * g_mark / np.sqrt(sq[0])
        bias += rate * g_bias / np.sqrt(sq[1])
        move = move + rate * g_move / np.sqrt(sq[2])
    weight[0] = 0.0
    p, _ = _expected(weight[borne].sum(axis=1)[ids] + bias, first, start, move)
    return Field({m: float(weight[i]) for m, i in marks.items()}, float(bias), start, move,
                 _logistic(_sums(p, bounds), labels.astype(float)))


# ---- scoring ----------------------------------------------------------------

def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of a half or more, as character offsets."""
    spans: list[dict] = []
    last = -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if p[i] >= 0.5:
            if last == i - 1:
                spans[-1]["end"] = m.end()
            else:
                spans.append({"start": m.start(), "end": m.end()})
            last = i
    return spans


class _Unary(dict):
    """Potential of each token; a bounded cache over the sum of its marks."""

    def __init__(self, field: Field):
        self.field = field

    def __missing__(self, word: str) -> float:
        get = self.field.weight.get
        value = self.field.bias + sum(get(m, 0.0) for m in marks_of(word))
        if len(self) >= 300_000:
            self.clear()
        self[word] = value
        return value


def _scorer(field: Field | None):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unary = _Unary(field)
        for block in rows_of(batches, 2_000_000):
            ids = pa.array([r[0] for r in block], pa.int64())
            if field is None:
                score, spans = np.zeros(len(block)), [[] for _ in block]
            else:
                docs = [tokens_of(r[1]) for r in block]
                first, bounds = _starts(docs)
                at = np.fromiter(map(unary.__getitem__, chain.from_iterable(docs)), float, bounds[-1])
                p = marginals(at, first, field.start, field.move)
                score = 1 / (1 + np.exp(-np.clip(_sums(p, bounds) @ field.judge, -30, 30)))
                spans = [_spans(r[1], own) if (own := p[bounds[i]:bounds[i + 1]]).max(initial=0) >= 0.5 else []
                         for i, r in enumerate(block)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(score, pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "score", "spans"])
    return run


def score(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row of ``docs``; spans are the character
    offsets of toxic passages."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # ``features`` weights, or the toxic marks

    def run(batches):
        return _scorer(shared.value)(batches)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double, spans array<struct<start:int,end:int>>")


def training_rows(docs: DataFrame, labels: DataFrame, without_remainder: int | None = 0) -> DataFrame:
    """(doc_id, toxic, text) of the labelled documents outside the held-out
    fifth; several texts under one id are all used.  Up to a million labels
    are sent to the texts; beyond that both are shuffled."""
    known = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    if without_remainder is not None:
        known = known.where(id_remainder(F.col("doc_id"), 5) != without_remainder)
    return docs.select("doc_id", "text").join(small(known, 1_000_000), "doc_id").select("doc_id", "toxic", "text")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, score, spans) for every row of ``docs``, learned from
    ``labels`` and the texts of the same table outside the held-out fifth."""
    return score(docs, fit(staged(training_rows(docs, labels), "toxicity"), settings))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
