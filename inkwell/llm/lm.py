"""Language-model scoring with a small causal self-attention model.

The model reads subword ids of a public tokenizer: embeddings, one masked
attention layer with a residual, and a softmax over classes of ids in two levels (a group of
classes, then a class of the group: 32 exponentials an id instead of 256), to which
the log transitions between classes are added.  An id has the probability of its
class times its share in the class.  What is counted comes from *all* training
documents, by aggregations on Spark: pairs of neighbouring ids, from them the
classes (clusters of ids with similar neighbours) and the class transitions, and
the shares.  Embeddings and attention start from a fit on windows drawn by a hash,
and then learn from every place of every training text, once: in rounds, each over a
part of the texts, tasks descend from the same model over their own texts, and what
they found is averaged (an id's embedding by how often a task met the id).  Every id
has a share, so that a text's probability is that of one distribution over all id
sequences.

Texts of any length are scored in windows of ``WINDOW`` inputs that advance by
``STEP``: the first window scores all its places, each later one only the places
that no window has scored, which therefore see at least ``WINDOW - STEP``
earlier ids.  Windows of many texts are one batch.

Beside it a word unigram over all training documents gives a base score.  Its
frequent words are sent to the tasks, a bounded number; rare words of a text
are kept aside, joined with the counts on the word, and added up.

Defined results: a null or empty text is the end token alone; a null id is
scored, counts as neither held out nor trained on; repeated rows are scored one
by one.  Without training documents the base counts are zero and the model is
uniform.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import ascii_words, coded_words, discard, id_remainder, mix64, rows_of, slices_of, staged, table
from inkwell.llm.subwords import drop_encoders, encoder

VOCABULARY = "word_bpe_49k.json"
#: Ids of the vocabulary; its start and end tokens.
SIZE, BEGIN, END = 49_408, 49_406, 49_407
WINDOW, STEP = 32, 24
#: Frequent ids whose neighbourhood describes an id; numbers that describe it.
MARKS, VECTOR = 256, 24


@dataclass(frozen=True)
class Settings:
    """Bounds of the training."""

    sample_docs: int = 1500  # the attention's start is fitted on as many windows as ...
    doc_windows: int = 128  # ... so many documents of this length have, about
    classes: int = 256
    width: int = 16
    steps: int = 3000
    batch: int = 64
    rate: float = 0.03
    rounds: int = 4  # in which all texts are learned from, each in one of them
    shard: int = 4_000_000  # ids that a task learns from in a round, about
    large: int = 256  # windows of a step in these tasks
    head_words: int = 500_000  # words whose counts are sent to the tasks


@dataclass
class Model:
    """The softmax over classes has two levels: a group of ``side`` classes, then
    a class of that group.  Columns of ``head``, ``bias`` and ``move`` are in the
    order of the groups; ``slot`` is the column of a class (None: as numbered)."""

    of: np.ndarray  # class of each id
    share: np.ndarray  # log share of each id in its class
    embed: np.ndarray
    place: np.ndarray
    qkv: np.ndarray
    out: np.ndarray
    head: np.ndarray
    bias: np.ndarray
    move: np.ndarray | None = None  # log transitions from a class to a class, given its group
    top: np.ndarray | None = None  # as head, bias and move, for the groups
    lift: np.ndarray | None = None
    rise: np.ndarray | None = None
    slot: np.ndarray | None = None


# ---- model ------------------------------------------------------------------

_PAST = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def side(classes: int) -> int:
    """Classes of a group: about as many as there are groups."""
    return isqrt(classes - 1) + 1


def _grid(columns: np.ndarray, fill: float = 0.0) -> np.ndarray:
    """The last axis (classes by slot) as group x class; the last group is
    filled up."""
    c = columns.shape[-1]
    s = side(c)
    spare = np.full((*columns.shape[:-1], -c % s), fill, columns.dtype)
    return np.concatenate([columns, spare], axis=-1).reshape(*columns.shape[:-1], -1, s)


def _slots(m: Model) -> np.ndarray:
    return np.arange(m.head.shape[-1]) if m.slot is None else m.slot


def _joint(m: Model) -> tuple[np.ndarray, np.ndarray]:
    """What the attention's four maps come to: queries with keys, values with
    the output."""
    d = m.embed.shape[1]
    q, k, v = m.qkv[:, :d], m.qkv[:, d:2 * d], m.qkv[:, 2 * d:]
    return (q * q.dtype.type(d ** -0.5)) @ k.T, v @ m.out


def _weights(p: np.ndarray, x: np.ndarray, out: np.ndarray, first: int = 0) -> np.ndarray:
    """What each place from ``first`` on gives to the places up to it, not yet
    divided by the sums, which are returned inverted."""
    s = np.matmul(p, x.transpose(0, 2, 1), out=out)
    np.clip(s, -80, 80, out=s)
    np.exp(s, out=s)
    s *= _PAST[first:]
    return 1 / (s.reshape(-1, WINDOW) @ np.ones(WINDOW, s.dtype))


def _attend(m: Model, ids: np.ndarray):
    """State of each place of windows of input ids, and what the gradient
    needs."""
    x = m.embed.take(ids, axis=0)
    x += m.place
    n, t, d = x.shape
    pairs, values = _joint(m)
    p = (x.reshape(-1, d) @ pairs).reshape(n, t, d)
    s = np.empty((n, t, t), x.dtype)
    r = _weights(p, x, s)[:, None]
    z = (s @ x).reshape(-1, d)
    z *= r
    h = z @ values
    h += x.reshape(-1, d)
    return h.reshape(n, t, d), (x, p, s, r, z, pairs, values)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def _group_logits(m: Model, h: np.ndarray, before: np.ndarray) -> np.ndarray:
    c = m.head.shape[-1]
    high = np.zeros((*h.shape[:-1], -(-c // side(c))), h.dtype)
    if m.top is not None:
        np.matmul(h, m.top, out=high)
        high += m.lift
    if m.rise is not None:
        high += m.rise.take(before, axis=0)
    return high


def _forward(m: Model, ids: np.ndarray):
    """Log probability of every class (window, place, class) after windows of
    input ids, and the states."""
    h, _ = _attend(m, ids)
    before = m.of[ids]
    low = h @ m.head + m.bias
    if m.move is not None:
        low = low + m.move[before]
    both = _log_softmax(_grid(low, -1e9)) + _log_softmax(_group_logits(m, h, before))[..., None]
    return both.reshape(*both.shape[:-2], -1)[..., _slots(m)], h


def _by_group(group: np.ndarray, groups: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The rows in the order of their groups, and each group with its part."""
    order = np.argsort(group.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    return order, [(g, slice(bounds[g], bounds[g + 1])) for g in np.flatnonzero(np.diff(bounds))]


def _minus_target(logits: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted loss and its gradient by the logits, which are overwritten."""
    flat = logits.reshape(-1)
    at = np.arange(0, flat.size, logits.shape[1])
    at += target
    np.minimum(logits, 80, out=logits)
    picked = flat.take(at)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    loss = ((np.log(total) - picked) * weight).sum()
    logits *= (weight / total)[:, None]
    flat[at] -= weight
    return loss, logits


def _gradient(m: Model, ids: np.ndarray, targets: np.ndarray, weight: np.ndarray):
    """Mean loss and gradients by parameter, for class targets.  Of the classes
    only those of the target's group are touched."""
    h, (x, p, s, r, z, pairs, values) = _attend(m, ids)
    n, t, d = x.shape
    w = (weight / weight.sum()).ravel().astype(h.dtype)
    h, one = h.reshape(-1, d), np.ones(n * t, h.dtype)
    before, goal = m.of.take(ids.ravel()), _slots(m).take(targets.ravel())
    c = m.head.shape[-1]
    head, bias = _grid(m.head).transpose(1, 0, 2).copy(), _grid(m.bias, -1e9)
    group, place = np.divmod(goal, side(c))
    loss, g = _minus_target(_group_logits(m, h, before), group, w)
    order, parts = _by_group(group, len(head))
    own, low = h.take(order, axis=0), np.empty((n * t, head.shape[2]), h.dtype)
    for i, rows in parts:
        np.matmul(own[rows], head[i], out=low[rows])
    if m.move is None:
        low += bias.take(group.take(order), axis=0)
    else:
        follow = _grid(m.move)
        follow += bias
        before *= len(head)
        before += group
        low += follow.reshape(-1, follow.shape[2]).take(before.take(order), axis=0)
    more, low = _minus_target(low, place.take(order), w.take(order))
    ghead, gbias, back = np.zeros_like(head), np.zeros_like(bias), np.empty_like(h)
    for i, rows in parts:
        np.matmul(own[rows].T, low[rows], out=ghead[i])
        gbias[i] = one[rows] @ low[rows]
        np.matmul(low[rows], head[i].T, out=back[rows])
    gh = np.empty_like(h)
    gh[order] = back
    grads = {"head": ghead.transpose(1, 0, 2).reshape(d, -1)[:, :c], "bias": gbias.reshape(-1)[:c]}
    if m.top is not None:
        grads |= {"top": h.T @ g, "lift": one @ g}
        gh += g @ m.top.T
    gvalues = z.T @ gh
    # of the states z, divided like the weights; and how much each weight is worth
    gz = gh @ values.T
    worth = np.einsum("nd,nd->n", gz, z)
    gz *= r
    worth *= r[:, 0]
    gs = gz.reshape(n, t, d) @ x.transpose(0, 2, 1)
    gs -= worth.reshape(n, t, 1)  # what the attention's shares take from each other
    gs *= s
    gp = (gs @ x).reshape(-1, d)
    gpairs = x.reshape(-1, d).T @ gp
    gx = gh + gp @ pairs.T
    gx = gx.reshape(n, t, d)
    gx += gs.transpose(0, 2, 1) @ p
    gx += s.transpose(0, 2, 1) @ gz.reshape(n, t, d)
    q, k, v = m.qkv[:, :d], m.qkv[:, d:2 * d], m.qkv[:, 2 * d:]
    scale = gpairs.dtype.type(d ** -0.5)
    grads["qkv"] = np.concatenate([gpairs @ k * scale, gpairs.T @ q * scale, gvalues @ m.out.T], axis=1)
    grads["out"] = v.T @ gvalues
    grads["place"] = gx.sum(axis=0)
    flat = ids.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    seen = flat.take(order)
    first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
    rows = gx.reshape(-1, d).take(order, axis=0)
    grads["embed"] = (seen[first].astype(np.int64), np.add.reduceat(rows, first, axis=0))  # of the ids in the batch
    return loss + more, grads


class _Adam:
    def __init__(self, rate: float, steps: int):
        self.rate, self.steps, self.at, self.state = rate, steps, 0, {}

    def update(self, m: Model, grads: dict) -> None:
        self.at += 1
        rate = self.rate * (1 - 0.9 * self.at / self.steps)
        scale = np.float32(rate * np.sqrt(1 - 0.99 ** self.at) / (1 - 0.9 ** self.at))
        for name, g in grads.items():
            value = getattr(m, name)
            if name not in self.state:
                self.state[name] = np.zeros((2, *value.shape) if name != "embed" else (len(value), 2, *value.shape[1:]), value.dtype)
            both = self.state[name]
            if name == "embed":  # only the rows of ids in the batch
                rows, g = g
                held = both.take(rows, axis=0)
                first, second = held[:, 0], held[:, 1]
            else:
                first, second = both
            first *= np.float32(0.9)
            first += np.float32(0.1) * g
            second *= np.float32(0.99)
            second += np.float32(0.01) * g * g
            move = np.sqrt(second)
            move += np.float32(1e-8)
            np.divide(first, move, out=move)
            move *= scale
            if name == "embed":
                both[rows] = held
                value[rows] = value.take(rows, axis=0) - move
            else:
                value -= move


def windows_of(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of documents given as ids with the end token: input ids, target
    ids (both window x place) and the document of each place that the window
    scores (-1: not scored).  First windows of documents come first."""
    sizes = np.array([len(d) for d in docs], np.int64)
    flat = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    return _cut(flat, sizes, *_turns(sizes))


def _turns(sizes: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Document and turn (from 0) of every window of documents of these sizes."""
    later = np.maximum(0, -(-(sizes - WINDOW) // step))
    turn = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later) + 1
    return (np.concatenate([np.arange(len(sizes)), np.repeat(np.arange(len(sizes)), later)]),
            np.concatenate([np.zeros(len(sizes), np.int64), turn]))


def _cut(flat: np.ndarray, sizes: np.ndarray, of: np.ndarray, turn: np.ndarray,
         step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of these documents and turns, as :func:`windows_of` has them."""
    starts = np.cumsum(sizes) - sizes
    at = turn[:, None] * step + np.arange(WINDOW)
    inside = at < sizes[of][:, None]
    place = starts[of][:, None] + np.minimum(at, sizes[of][:, None] - 1)
    targets = flat[place]
    inputs = np.where(at > 0, flat[np.maximum(place - 1, 0)], BEGIN)
    scored = inside & ((np.arange(WINDOW) >= WINDOW - step) | (turn[:, None] == 0))
    return inputs, targets, np.where(scored, of[:, None], -1)


class Scorer:
    """A model made ready for inference."""

    def __init__(self, m: Model):
        self.m = m
        d = m.embed.shape[1]
        pairs, values = _joint(m)
        self.values = values.astype(np.float32)
        self.input = np.hstack([m.embed, m.embed @ pairs]).astype(np.float32)  # of each id, and its query
        self.place = np.hstack([m.place, m.place @ pairs]).astype(np.float32)
        self.head = _grid(m.head).transpose(1, 0, 2).astype(np.float32)
        groups, own = len(self.head), self.head.shape[2]
        self.top = np.zeros((d, groups), np.float32) if m.top is None else m.top.astype(np.float32)
        # what follows on a class: of each group, and of the classes of each group
        classes = m.head.shape[-1]
        self.rise = (np.zeros((classes, groups)) if m.rise is None else m.rise) + (0 if m.lift is None else m.lift)
        self.rise = self.rise.astype(np.float32)
        move = np.zeros((classes, groups, own)) if m.move is None else _grid(m.move)
        self.move = (move + _grid(m.bias, -1e9)).reshape(-1, own).astype(np.float32)
        self.group, self.at = np.divmod(_slots(m)[m.of], own)

    def logs(self, inputs: np.ndarray, targets: np.ndarray, first: int) -> np.ndarray:
        """Log probabilities of the targets from place ``first`` on."""
        m, d = self.m, self.m.embed.shape[1]
        n, kept = len(inputs), WINDOW - first
        both = self.input.take(inputs, axis=0)
        both += self.place
        x = both[..., :d]
        s = np.empty((n, kept, WINDOW), np.float32)
        r = _weights(both[:, first:, d:], x, s, first)
        z = (s @ x).reshape(-1, d)
        z *= r[:, None]
        h = z @ self.values
        h.reshape(n, kept, d)[...] += x[:, first:]
        want, before = targets[:, first:].ravel(), m.of.take(inputs[:, first:].ravel())
        group = self.group.take(want)
        high = h @ self.top
        high += self.rise.take(before, axis=0)
        order, parts = _by_group(group, len(self.head))
        own, low = h.take(order, axis=0), np.empty((len(h), self.head.shape[2]), np.float32)
        for g, rows in parts:
            np.matmul(own[rows], self.head[g], out=low[rows])
        before *= len(self.head)
        before += group
        low += self.move.take(before.take(order), axis=0)
        found = self._log(high, group) + m.share.take(want)
        found[order] += self._log(low, self.at.take(want).take(order))
        return found.reshape(n, kept)

    @staticmethod
    def _log(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log of the target's share; the logits are overwritten."""
        np.minimum(logits, 80, out=logits)
        picked = logits.reshape(-1).take(np.arange(0, logits.size, logits.shape[1]) + target)
        np.exp(logits, out=logits)
        return picked - np.log(logits @ np.ones(logits.shape[1], np.float32))

    def score(self, docs: list[np.ndarray], batch: int = 128) -> np.ndarray:
        """Natural log probability of each document (ids with the end token)."""
        out = np.zeros(len(docs))
        inputs, targets, of = windows_of(docs)
        for a, b, first in ((0, len(docs), 0), (len(docs), len(inputs), WINDOW - STEP)):
            for at in range(a, b, batch):
                part = slice(at, min(b, at + batch))
                found, mine = self.logs(inputs[part], targets[part], first), of[part, first:]
                kept = mine >= 0
                out += np.bincount(mine[kept], found[kept], len(docs))
        return out


# ---- training ---------------------------------------------------------------

def marks_of(counts: np.ndarray) -> np.ndarray:
    """Column of each id among the most frequent ones, or -1."""
    often = np.argsort(-counts, kind="stable")[:MARKS]
    column = np.full(SIZE, -1, np.int64)
    column[often] = np.arange(len(often))
    return column


def cells_of(left, right, n, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, mark, n): how often a mark follows an id (from 0), or comes before
    it (from ``MARKS``), of counts of neighbouring ids."""
    parts = []
    for a, b, shift in ((left, right, 0), (right, left, MARKS)):
        c = column[b]
        kept = c >= 0
        parts.append((a[kept], c[kept] + shift, n[kept]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _profiles(ids: np.ndarray, mark: np.ndarray, n: np.ndarray, block: int = 4096):
    """Ids and their neighbourhoods (rows of length one), in blocks of ids."""
    seen, row = np.unique(ids, return_inverse=True)
    order = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[order], np.arange(0, len(seen) + block, block))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        at = order[a:b]
        own = seen[i * block:(i + 1) * block]
        x = np.zeros((len(own), 2 * MARKS), np.float32)
        x[row[at] - i * block, mark[at]] = np.sqrt(n[at])
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        yield own, x


def _gram(ids, mark, n, weight: np.ndarray) -> np.ndarray:
    """Weighted second moments of the neighbourhoods."""
    total = np.zeros((2 * MARKS, 2 * MARKS))
    for own, x in _profiles(ids, mark, n):
        total += (x * weight[own][:, None].astype(np.float32)).T @ x
    return total


def _axes(gram: np.ndarray) -> np.ndarray:
    return np.linalg.eigh(gram)[1][:, -VECTOR:].astype(np.float32)


def cluster_ids(x: np.ndarray, n: np.ndarray, classes: int, rounds: int = 15) -> np.ndarray:
    """Class of every id: k-means over the vectors ``x`` of its neighbours,
    weighed by its count; ids that never occur are the last class."""
    seen = np.flatnonzero(n)
    of = np.full(SIZE, classes - 1, np.int64)
    if len(seen) <= classes - 1:
        of[seen] = np.arange(len(seen))
        return of
    x, weight = x[seen], n[seen].astype(float)
    # the most frequent ids have a class of their own, the others share the rest
    alone = (classes - 1) // 3
    often = np.argsort(-weight, kind="stable")
    of[seen[often[:alone]]] = np.arange(alone)
    rest = often[alone:]
    k = min(classes - 1 - alone, len(rest))
    centre = x[rest[:k]].copy()
    for _ in range(rounds):
        near = ((centre ** 2).sum(axis=1) - 2 * x[rest] @ centre.T).argmin(axis=1)
        mass = np.bincount(near, weight[rest], k)
        sums = np.zeros_like(centre)
        np.add.at(sums, near, x[rest] * weight[rest][:, None].astype(np.float32))
        centre = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centre).astype(np.float32)
    of[seen[rest]] = alone + near
    return of


def _moves(of: np.ndarray, left, right, n, classes: int) -> np.ndarray:
    """Counts of neighbouring classes, flat."""
    return np.bincount(of[left] * classes + of[right], n, classes * classes)


def grouped(columns: np.ndarray, size: int) -> np.ndarray:
    """The columns in an order in which each ``size`` neighbours are alike:
    halves along the principal direction, again and again."""
    def halves(own: np.ndarray) -> np.ndarray:
        left = -(-len(own) // size) // 2 * size
        if not left:
            return own
        x = columns[:, own] - columns[:, own].mean(axis=1, keepdims=True)
        own = own[np.argsort(np.linalg.eigh(x.T @ x)[1][:, -1], kind="stable")]
        return np.concatenate([halves(own[:left]), halves(own[left:])])

    return halves(np.arange(columns.shape[1]))


def fit_windows(inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray, of: np.ndarray, moves: np.ndarray,
                counts: np.ndarray, settings: Settings) -> Model:
    """A model from windows (input ids, target ids, whether a target is
    scored), the classes, their transitions and the counts of all ids in the
    training corpus."""
    rng = np.random.default_rng(0)
    d, c = settings.width, settings.classes
    smooth = counts + 0.5
    share = np.log(smooth / np.bincount(of, smooth, c)[of])
    normal = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
    groups = -(-c // side(c))
    m = Model(of, share.astype(np.float32), normal(SIZE, d), normal(WINDOW, d), normal(d, 3 * d), normal(d, d),
              normal(d, c), np.zeros(c, np.float32), top=normal(d, groups), lift=np.zeros(groups, np.float32))
    if not len(inputs):
        m.bias[:] = np.where(np.arange(c) == 0, 0, -1e9)
        m.lift[:] = np.where(np.arange(groups) == 0, 0, -1e9)
        m.head[:] = m.top[:] = 0
        return m
    whole = np.bincount(of, smooth, c) / smooth.sum()
    moves = moves.reshape(c, c) + 10 * whole
    moves = moves / moves.sum(axis=1, keepdims=True) + 1e-12
    order = grouped(np.log(moves / (whole + 1e-12)) * np.sqrt(whole)[:, None], side(c))
    m.slot = np.empty(c, np.int64)
    m.slot[order] = np.arange(c)
    grid = _grid(moves[:, order])
    m.rise = np.log(grid.sum(axis=2)).astype(np.float32)
    m.move = np.log(moves[:, order] / np.repeat(grid.sum(axis=2), grid.shape[2], axis=1)[:, :c]).astype(np.float32)
    adam = _Adam(settings.rate, settings.steps)
    for _ in range(settings.steps):
        pick = rng.integers(0, len(inputs), settings.batch)
        _, grads = _gradient(m, inputs[pick], of[targets[pick]], scored[pick].astype(np.float32))
        adam.update(m, grads)
    return m


#: What is learned, but for the embeddings.
_DENSE = ("place", "qkv", "out", "head", "bias", "top", "lift")
_LEARNED = "part int, weight binary, value binary"
#: The same of one task: only of ids that it met, given by their place in the part.
_FOUND = "part int, ids binary, weight binary, value binary"
#: Parts of the embeddings that are averaged apart.
_PARTS = 16
_SPLIT = np.array_split(np.arange(SIZE), _PARTS)


def _descend(model: Model, rate: float, settings: Settings):
    """Of rows (ids): what a descent from ``model`` over all their places comes
    to, multiplied by its weight: embeddings in parts, by how often each id was
    met; part -1 is all else, by the windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        m = replace(model, embed=model.embed.copy(), **{x: getattr(model, x).copy() for x in _DENSE})
        adam, met, windows, rng = _Adam(rate, np.inf), np.zeros(SIZE), 0, np.random.default_rng(0)
        for block in rows_of(batches, 400_000):
            docs = [_ids(r[0]) for r in block]
            sizes = np.array([len(d) for d in docs], np.int64)
            inputs, targets, scored = _cut(np.concatenate(docs), sizes, *_turns(sizes, WINDOW), WINDOW)
            steps = -(-len(inputs) // settings.large)
            for pick in np.array_split(rng.permutation(len(inputs)), steps):
                _, grads = _gradient(m, inputs[pick], m.of[targets[pick]], (scored[pick] >= 0).astype(np.float32))
                adam.update(m, grads)
            met += np.bincount(inputs.ravel(), minlength=SIZE)
            windows += len(inputs)
        if windows:
            dense = np.concatenate([getattr(m, x).ravel() for x in _DENSE]) * windows
            rows = [(-1, np.zeros(0), np.array([windows]), dense)]
            for i, own in enumerate(_SPLIT):
                own = own[(met[own] > 0) | (own == own[0])]  # a task of few texts has few ids to tell of
                rows.append((i, own - own[0], met[own], m.embed[own] * met[own][:, None]))
            part, *packed = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32())] + [pa.array([np.asarray(x, t).tobytes() for x in v], pa.binary())
                                                for v, t in zip(packed, (np.uint16, np.float64, np.float32))],
                names=["part", "ids", "weight", "value"])
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of what tasks learned, by part."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for i in range(b.num_rows):  # one in memory
            part, ids, weight, value = (c[i].as_py() for c in b.columns)
            w, x = np.frombuffer(weight), np.frombuffer(value, np.float32)
            ids = np.frombuffer(ids, np.uint16) if part >= 0 else np.zeros(1, np.int64)
            if part not in sums:
                size = len(_SPLIT[part]) if part >= 0 else 1
                sums[part] = np.zeros(size), np.zeros((size, len(x) // len(ids)))
            for total, more in zip(sums[part], (w, x.reshape(len(ids), -1))):
                total[ids] += more
    yield pa.RecordBatch.from_arrays(
        [pa.array(sums, pa.int32()), *(pa.array([s[i].tobytes() for s in sums.values()], pa.binary()) for i in (0, 1))],
        names=["part", "weight", "value"])


def learned(rows: DataFrame, model: Model, ids: float, settings: Settings) -> Model:
    """``model`` after it has learned from all of ``rows`` (doc_id, ids), which
    hold about so many ids.  A row's round and task are a hash of it, so that the
    same rows make the same model however they are stored.  The driver gets one
    model a round."""
    spark, rounds = rows.sparkSession, settings.rounds
    shards = int(ids / rounds / settings.shard) + 1
    mixed = F.xxhash64("doc_id", "ids", F.lit(40_503))
    rows = rows.select("ids", mixed.alias("mixed"))
    for r in range(rounds):
        # each round goes on slower, from where the fit of the start ended
        shared = spark.sparkContext.broadcast(model)  # bounded by SIZE
        rate = settings.rate * 0.1 * (1 - r / rounds)

        def run(batches, shared=shared, rate=rate):
            return _descend(shared.value, rate, settings)(batches)

        mine = rows.where(F.pmod("mixed", F.lit(rounds)) == r).repartition(shards, "mixed").sortWithinPartitions("mixed")
        found = mine.select("ids").mapInArrow(run, _FOUND).repartition(_PARTS + 1, "part").mapInArrow(_summed, _LEARNED).toArrow()
        sums = {p: (np.frombuffer(w), np.frombuffer(x)) for p, w, x in zip(*(found[c].to_pylist() for c in ("part", "weight", "value")))}
        shared.destroy()
        if not sums:
            continue
        weight, dense = sums[-1]
        ends = np.cumsum([getattr(model, x).size for x in _DENSE])[:-1]
        new = {x: v.reshape(getattr(model, x).shape).astype(np.float32) for x, v in zip(_DENSE, np.split(dense / weight, ends))}
        met = np.concatenate([sums[i][0] for i in range(_PARTS)])[:, None]
        total = np.concatenate([sums[i][1] for i in range(_PARTS)]).reshape(SIZE, -1)
        embed = np.where(met > 0, total / np.maximum(met, 1), model.embed).astype(np.float32)
        model = replace(model, embed=embed, **new)
    return model


def fit(docs: list[np.ndarray], counts: np.ndarray, settings: Settings) -> Model:
    """A model from documents in memory (ids with the end token) and the counts
    of all ids in the training corpus."""
    if not docs:
        none = np.zeros((0, WINDOW), np.int64)
        return fit_windows(none, none, none, np.zeros(SIZE, np.int64), np.zeros(settings.classes ** 2), counts, settings)
    inputs, targets, scored = windows_of(docs)
    key, n = _pairs_of(docs)
    left, right = key // SIZE, key % SIZE
    counts_in = counts.copy()
    counts_in[BEGIN] += len(docs)
    cells = cells_of(left, right, n, marks_of(counts_in))
    axes, x = _axes(_gram(*cells, counts_in)), np.zeros((SIZE, VECTOR), np.float32)
    for own, rows in _profiles(*cells):
        x[own] = rows @ axes
    of = cluster_ids(x, counts_in, settings.classes)
    return fit_windows(inputs, targets, scored >= 0, of, _moves(of, left, right, n, settings.classes), counts, settings)


def _pairs_of(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring ids of texts as left * SIZE + right, distinct, with their
    counts; the first id of a text has BEGIN to its left."""
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    right = np.concatenate(docs)
    left = np.concatenate([[BEGIN], right[:-1]])
    left[np.cumsum(sizes) - sizes] = BEGIN
    return np.unique(left * SIZE + right, return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


#: A target that the window does not score, in drawn windows.
_NOT_SCORED = 65_535
_GATHERED = "left int, right int, n long, window binary"


def _ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u2").astype(np.int64)


def _gather(limit: int):
    """Of rows (doc_id, ids): counts of neighbouring ids, and the windows whose
    40-bit hash of document and turn is below ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def batch(key, n, drawn) -> pa.RecordBatch:
            a, b = len(key), len(drawn)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(v, t), pa.nulls(b, t)]) for v, t in
                 ((key // SIZE, pa.int32()), (key % SIZE, pa.int32()), (n, pa.int64()))]
                + [pa.concat_arrays([pa.nulls(a, pa.binary()), pa.array(drawn, pa.binary())])],
                names=["left", "right", "n", "window"])

        for block in rows_of(batches, 1_000_000):
            docs = [_ids(r[1]) for r in block]
            sizes = np.array([len(d) for d in docs], np.int64)
            owner, turn = _turns(sizes)
            of = mix64(np.array([r[0] or 0 for r in block], np.int64))
            chosen = np.flatnonzero((mix64(of[owner] + turn.astype(np.uint64)) >> np.uint64(24)) < np.uint64(limit))
            inputs, targets, scored = _cut(np.concatenate(docs), sizes, owner[chosen], turn[chosen])
            both = np.stack([inputs, np.where(scored >= 0, targets, _NOT_SCORED)], axis=1)
            drawn = [w.tobytes() for w in both.astype(np.uint16)]
            parts.append(_pairs_of(docs))
            held += len(parts[-1][0])
            full = held > 1_000_000
            yield batch(*_merged(parts if full else []), drawn)
            if full:
                parts, held = [], 0
        yield batch(*_merged(parts), [])
    return run


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3


def classes_of(pairs: DataFrame, counts: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the ids and counts of neighbouring classes, from (left, right,
    n) of all training documents.  Bounded by the vocabulary: the driver gets
    one vector an id."""
    column = marks_of(counts)

    def cells(batches):
        for b in batches:
            left, right, n = (c.to_numpy() for c in b.columns)
            found = cells_of(left, right, n, column)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found, (pa.int32(), pa.int32(), pa.int64()))],
                                             names=["id", "mark", "n"])

    by_id = pairs.mapInArrow(cells, "id int, mark int, n long").repartition(16, "id")

    def gram(batches):
        yield pa.RecordBatch.from_arrays([pa.array([_gram(*_columns(batches), counts).tobytes()], pa.binary())], names=["gram"])

    axes = _axes(sum(np.frombuffer(r["gram"]).reshape(2 * MARKS, -1) for r in by_id.mapInArrow(gram, "gram binary").toLocalIterator()))

    def vectors(batches):
        for own, rows in _profiles(*_columns(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([r.tobytes() for r in rows @ axes], pa.binary())],
                                             names=["id", "vector"])

    found, x = by_id.mapInArrow(vectors, "id int, vector binary").toArrow(), np.zeros((SIZE, VECTOR), np.float32)
    x[found["id"].to_numpy()] = np.frombuffer(b"".join(found["vector"].to_pylist()), np.float32).reshape(-1, VECTOR)
    of = cluster_ids(x, counts, classes)

    def moves(batches):
        total = np.zeros(classes * classes)
        for b in batches:
            total += _moves(of, *(c.to_numpy() for c in b.columns), classes)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["at", "n"])

    sums = pairs.mapInArrow(moves, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(classes * classes)
    out[sums["at"].to_numpy()] = sums["n"].to_numpy()
    return of, out


def subwords(words: list[list[bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The encoder's number of each word, and the ids of each text with the end
    token."""
    numbers, ids, bounds = encoder(VOCABULARY, bytes).look_up(words)
    return numbers, [np.append(ids[a:b].astype(np.int64), END) for a, b in zip(bounds[:-1], bounds[1:])]


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id counts from word counts: a text's ids are those of its words in a
    row.  No more rows per task than the vocabulary has."""
    total = np.zeros(SIZE)
    words = encoder(VOCABULARY, bytes)
    for block in rows_of(b.select([1, 0]) for b in batches):
        # every word comes once, so there is nothing to remember
        ids, sizes = words.ids_of([w for _, w in block])
        total += np.bincount(ids, np.repeat(np.array([n for n, _ in block], np.int64), sizes), SIZE)
    total = total.astype(np.int64)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0

    def merged() -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def batches_of(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from counts.set_column(0, "word", counts["word"].cast(pa.string(), safe=False)).to_batches(100_000)

    for block in slices_of(batches, 4_000_000):
        words, at, _ = coded_words(block.column(0))
        parts.append(pa.table({"word": words, "n": np.bincount(at, minlength=len(words))}))
        held += len(words)
        if held > 800_000:
            parts = [merged()]
            held = len(parts[0])
            if held > 400_000:
                yield from batches_of(parts[0])
                parts, held = [], 0
    if parts:
        yield from batches_of(merged())


@dataclass
class Unigram:
    """Frequent words with their counts; totals of the training tokens."""

    head: dict[bytes, int]
    tokens: int
    documents: int
    norm: float  # N + (V + 1) / 2


def unigram(words: DataFrame, documents: int, most: int) -> Unigram:
    """From the counts (word, n) of all training words."""
    v, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    sizes = sorted((r["size"], r["words"]) for r in words.groupBy(F.floor(F.log2("n")).alias("size"))
                   .agg(F.count(F.lit(1)).alias("words")).collect())
    least, kept = 0, v
    for size, n in sizes:
        if kept <= most:
            break
        least, kept = size + 1, kept - n
    head = words.where(F.col("n") >= (1 << least)).toArrow()
    known = {w.encode("utf-8", "surrogatepass"): n for w, n in zip(head["word"].to_pylist(), head["n"].to_pylist())}
    tokens = total + documents
    return Unigram(known, tokens, documents, tokens + 0.5 * (v + (documents > 0) + 1))


# ---- ids and base scores ----------------------------------------------------

_ENCODED = ("doc_id long, trained boolean, n_tokens long, n_known long, base double, "
            "rare array<struct<word:string,times:int>>, ids binary")


def _encode(base: Unigram):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, epoch = encoder(VOCABULARY, bytes), -1
        end = float(np.log10((base.documents + 0.5) / base.norm))
        for block in slices_of(batches, 2_000_000):
            found, at, size = coded_words(block.column("text"))
            numbers, flat, bounds = words.look_up_coded(found.to_pylist(), at, size)
            if epoch != words.epoch:
                epoch, names, value = words.epoch, [], np.zeros(0)
            fresh = list(islice(words.index, len(names), None))
            counts = np.array([base.head.get(w, np.nan) for w in fresh], float)
            value = np.concatenate([value, np.log10((counts + 0.5) / base.norm)])  # nan: not a frequent word
            names += fresh
            docs = len(size)
            of = np.repeat(np.arange(docs), size)
            mine = value[numbers]
            rare = np.isnan(mine)
            known = np.bincount(of[~rare], minlength=docs) + (base.documents > 0)
            sums = np.bincount(of[~rare], mine[~rare], docs) + end
            pair, times = np.unique(of[rare] * len(names) + numbers[rare], return_counts=True)
            found = pa.StructArray.from_arrays(
                [pa.array([names[i].decode("utf-8", "surrogatepass") for i in (pair % max(1, len(names))).tolist()], pa.string()),
                 pa.array(times, pa.int32())], names=["word", "times"])
            ends = np.searchsorted(pair, np.arange(docs + 1) * len(names))
            ids = np.insert(flat.astype("<u2"), bounds[1:], END)  # after the ids of each text
            places = 2 * (bounds + np.arange(docs + 1))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("trained"),
                 pa.array(size + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                 pa.Array.from_buffers(pa.binary(), docs, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)])],
                names=["doc_id", "trained", "n_tokens", "n_known", "base", "rare", "ids"])
    return run


def encoded(docs: DataFrame, base: Unigram, trained: Column | None = None,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of every row of ``docs`` (16 bits each, with the end token) and the
    base score of its frequent words, staged: training and scoring read these."""
    shared = docs.sparkSession.sparkContext.broadcast(base)  # bounded by ``head_words``

    def run(batches):
        return _encode(shared.value)(batches)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.lit(True) if trained is None else trained, F.lit(False)).alias("trained"),
                       F.col(text_col).cast("binary").alias("text"))
    return staged(rows.mapInArrow(run, _ENCODED), "encoded")


# ---- training on a corpus ---------------------------------------------------

def statistics(texts: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Unigram, np.ndarray]:
    """Word counts, unigram and id counts from all rows of ``texts`` (text)."""
    words = staged(texts.select(F.col("text").cast("binary")).mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")),
                   "words")
    documents, counts = texts.count(), np.zeros(SIZE)
    ids = words.mapInArrow(_id_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts[ids["id"].to_numpy()] = ids["n"].to_numpy()  # no more rows than the vocabulary
    counts[END] += documents
    return words, unigram(words, documents, settings.head_words), counts


def fit_corpus(rows: DataFrame, base: Unigram, counts: np.ndarray, settings: Settings = Settings()) -> Model:
    """The model from all rows (doc_id, ids) of the training documents."""
    documents = base.documents
    if not documents:
        return fit([], counts, settings)
    windows = counts.sum() / STEP + documents  # no fewer than there are
    limit = int((1 << 40) * min(1.0, settings.sample_docs * settings.doc_windows / windows))
    gathered = staged(rows.select("doc_id", "ids").mapInArrow(_gather(limit), _GATHERED), "gathered")
    pairs = staged(gathered.where("window is null").groupBy("left", "right").agg(F.sum("n").alias("n")), "pairs")
    drawn = sorted(gathered.where("window is not null").select("window").toArrow()["window"].to_pylist())
    discard(gathered)
    drawn = np.frombuffer(b"".join(drawn), np.uint16).reshape(-1, 2, WINDOW)
    scored = drawn[:, 1] != _NOT_SCORED
    counts_in = counts.copy()
    counts_in[BEGIN] += documents
    of, moves = classes_of(pairs, counts_in, settings.classes)
    start = fit_windows(drawn[:, 0].astype(np.int64), np.where(scored, drawn[:, 1], END), scored, of, moves, counts, settings)
    return learned(rows.select("doc_id", "ids"), start, counts.sum(), settings)


def train(texts: DataFrame, settings: Settings = Settings()) -> tuple[Model, Unigram, DataFrame]:
    """Model, unigram and the word counts from all rows of ``texts`` (doc_id,
    text)."""
    words, base, counts = statistics(texts, settings)
    return fit_corpus(encoded(texts, base), base, counts, settings), base, words


# ---- scoring ----------------------------------------------------------------

_KEPT = ["doc_id", "n_tokens", "n_known", "base", "rare"]
_SCORED = "doc_id long, n_tokens long, n_known long, base double, rare array<struct<word:string,times:int>>, score double"


def scored_ids(rows: DataFrame, model: Model, base: Unigram, words: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of
    :func:`encoded`."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by SIZE

    def run(batches):
        drop_encoders()
        scorer = Scorer(shared.value)
        for b in batches:
            found = [scorer.score([_ids(r[0]) for r in block]) for block in rows_of(iter([b.select(["ids"])]), 400_000)]
            score = np.concatenate([np.zeros(0), *found]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*b.select(_KEPT).columns, pa.array(score, pa.float64())], names=[*_KEPT, "score"])

    first = staged(rows.select(*_KEPT, "ids").mapInArrow(run, _SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = first.select("row", F.inline("rare")).join(words, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / base.norm)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("known"))
    return first.drop("rare").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")


def scored(docs: DataFrame, model: Model, base: Unigram, words: DataFrame,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``."""
    return scored_ids(encoded(docs, base, None, id_col, text_col), model, base, words)


def op9_attention_lm(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), 5)
    words, base, counts = statistics(docs.where(remainder != 1))
    rows = encoded(docs, base, remainder != 1)
    model = fit_corpus(rows.where("trained"), base, counts)
    return scored_ids(rows, model, base, words).select(
        "doc_id", (remainder == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(base.tokens).cast("long").alias("train_tokens"), "base_score", "score")
