"""Best-fit packing of documents into sequences by swap-based local search.

A document is its subword ids and a closing id 0.  Only documents longer than a
sequence are cut, into full pieces and a rest; full pieces are sequences by
themselves.  The others go through rounds.  A round deals the open pieces to
groups of bounded size by hash and packs each group on its own: best-fit
decreasing, then exchanges that increase the sum of squared fills.  The donor is
the emptiest underfull bin; a move, a one-for-one or a two-for-one exchange
passes some of its tokens to a fuller bin, the one of largest gain first, until
the donor is empty and gone or nothing helps.  A group loses at most a bin or so
by being alone.  To win that back, the fuller half of its bins is sealed, and the
pieces of the emptier half meet in half as many groups or fewer in the next round,
until one group is left or the bins passed on are as few as their volume allows.
Bins halve from round to round, so that all rounds cost about twice the first.

Defined results: a null or empty text is the closing id alone; a null id is
packed like any other; repeated rows are packed as often as they occur (pieces
are told apart by a row number, not by the id).  An empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import rows_of, staged, table
from inkwell.llm.subwords import encoder

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
#: Pieces that are packed together in one task.
GROUP = 8192
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(vocabulary: str, length: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for block in rows_of(batches):
            out = []
            for (doc, _), ids in zip(block, encode([r[1] for r in block])):
                ids = ids.astype("<u4").tobytes() + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """One row per piece of at most ``length`` ids."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(_cutter(vocabulary, length), _PIECES)


# ---- one group --------------------------------------------------------------

def best_fit(lengths: np.ndarray, room: int) -> np.ndarray:
    """Bin of each piece, by best-fit decreasing.  Bins are found by the space
    they have left, through a bit mask of the spaces that occur."""
    bins = np.empty(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(room + 1)]
    mask, count = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                mask &= ~(1 << space)
        else:
            space, b = room, count
            count += 1
        bins[i] = b
        by_space[space - n].append(b)
        mask |= 1 << (space - n)
    return bins


def _best_exchange(own: np.ndarray, donor: int, lengths, bins, fill, under, room):
    """The exchange of largest gain between the donor's pieces ``own`` and the
    pieces of the other underfull bins: (gain, given pieces, taken piece or -1,
    target), or None.  Passing d tokens to a bin of fill f raises the squared
    fills by 2 d (f - fill[donor] + d)."""
    sizes = lengths[own]
    one = np.argsort(sizes, kind="stable")
    first, second = np.triu_indices(len(own), 1)
    sums = np.concatenate([sizes, sizes[first] + sizes[second]])
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    best = None

    def take(target, spare, returned, given_sizes, given):
        nonlocal best
        at = np.searchsorted(given_sizes, spare + returned, "right") - 1
        d = given_sizes[np.maximum(at, 0)] - returned
        ok = (at >= 0) & (d > 0)
        gain = np.where(ok, 2 * d * (fill[target] - fill[donor] + d), 0)
        if len(gain) and gain.max() > (best[0] if best else 0):
            i = int(gain.argmax())
            best = (int(gain[i]), given(int(at[i])), i, int(target[i]))

    targets = np.flatnonzero(under)
    take(targets, room - fill[targets], 0, sizes[one], lambda j: [own[one[j]]])
    if best:
        best = (*best[:2], -1, best[3])
    others = np.flatnonzero(under[bins])
    moved = best

    def pair(j):
        j = int(order[j])
        return [own[j]] if j < len(own) else [own[first[j - len(own)]], own[second[j - len(own)]]]

    take(bins[others], room - fill[bins[others]], lengths[others], sums, pair)
    if best is not moved:
        best = (best[0], best[1], int(others[best[2]]), best[3])
    return best


def _masks(sizes: list[int], room: int) -> tuple[int, int, int, int]:
    """What a bin of pieces of these sizes gives and takes: its smallest piece,
    a bit for the size of each piece and of each two, the space left, and a bit
    for what it takes for one of its pieces (more than the piece, no more than
    piece and space)."""
    count: dict[int, int] = {}
    for n in sizes:
        count[n] = count.get(n, 0) + 1
    spare = room - sum(sizes)
    ones = gives = takes = 0
    for n in count:
        ones |= 1 << n
    for n, c in count.items():
        gives |= (ones if c > 1 else ones ^ (1 << n)) << n
        takes |= ((1 << spare) - 1) << (n + 1)
    return min(sizes), ones | gives, spare, takes


def local_search(lengths: np.ndarray, bins: np.ndarray, room: int) -> np.ndarray:
    """Bins after exchanges; their number never grows.  A bin tried in vain is
    tried again with the bins changed since, of which bit masks tell whether any
    exchange with them helps; the pieces are gone through only if one does, or if
    the bin itself has changed."""
    bins = bins.copy()
    fill = np.bincount(bins, lengths).astype(np.int64)
    # when a bin changed, and when it was last tried in vain as the donor
    changed, tried, clock = np.ones(len(fill), np.int64), np.zeros(len(fill), np.int64), 1
    known: dict[int, tuple[int, int, int, int]] = {}
    latest: dict[int, int] = {}  # changed bins and when, the last one at the end

    def masks(b: int) -> tuple[int, int, int, int]:
        if b not in known:
            known[b] = _masks(lengths[bins == b].tolist(), room)
        return known[b]

    def in_vain(donor: int, own_fill: int, since: int) -> bool:
        least, gives, _, _ = masks(donor)
        for at, b_fill, spare, takes in recent:
            if at <= since:
                return True
            if b_fill >= own_fill and (least <= spare or gives & takes):
                return False
        return True

    while True:
        live = (fill > 0) & (fill < room)
        if (room - fill[live]).sum() < room:
            return bins  # no packing has fewer bins
        donors = np.flatnonzero(live & (tried < clock))
        donors = donors[np.argsort(fill[donors], kind="stable")]
        recent = [(at, int(fill[b]), *masks(b)[2:]) for b, at in reversed(latest.items()) if live[b]]
        now = clock
        for donor, own_fill, since, last in zip(*(x[donors].tolist() for x in (np.arange(len(fill)), fill, tried, changed))):
            # with the bins not changed since, nothing helped and nothing is different
            if last <= since and in_vain(donor, own_fill, since):
                tried[donor] = clock
                continue
            live[donor] = False
            while fill[donor] > 0:
                under = live & (fill < room) & (fill >= fill[donor])
                if changed[donor] <= tried[donor]:
                    under &= changed > tried[donor]
                found = _best_exchange(np.flatnonzero(bins == donor), donor, lengths, bins, fill, under, room) if under.any() else None
                if not found:
                    tried[donor] = clock
                    break
                _, given, taken, target = found
                passed = int(lengths[given].sum())
                bins[given] = target
                if taken >= 0:
                    bins[taken] = donor
                    passed -= int(lengths[taken])
                fill[target] += passed
                fill[donor] -= passed
                clock += 1
                changed[donor] = changed[target] = clock
                for b in (donor, target):
                    known.pop(b, None)
                    latest.pop(b, None)
                    latest[b] = clock
            live[donor] = True
            if clock > now:
                break
        else:
            return bins


def pack_group(rows: np.ndarray, lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset in the bin, and whether the bin is not full and of the emptier
    half, of each piece."""
    bins = local_search(lengths, best_fit(lengths, room), room)
    order = np.lexsort((rows, bins))
    in_order = lengths[order]
    ends = np.cumsum(in_order)
    fresh = np.append(True, np.diff(bins[order]) > 0)
    base = np.maximum.accumulate(np.where(fresh, ends - in_order, 0))
    offset = np.empty(len(rows), np.int64)
    offset[order] = ends - in_order - base
    fill = np.bincount(bins, lengths).astype(np.int64)
    used = np.flatnonzero(fill)
    emptier = np.zeros(len(fill), bool)
    emptier[used[np.argsort(fill[used], kind="stable")][:-(-len(used) // 2)]] = True
    return bins, offset, (emptier & (fill < room))[bins]


# ---- rounds -----------------------------------------------------------------

def _pack_round(turn: int, room: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bins, offset, open_ = pack_group(part["row"].to_numpy(), part["length"].to_numpy(), room)
        return pd.DataFrame({
            "row": part["row"].to_numpy(), "length": part["length"].to_numpy(),
            "sequence_id": (turn << 56) + (int(key[0]) << 24) + bins, "offset": offset, "open": open_})
    return run


def pack(cut: DataFrame, room: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(row, sequence_id, offset) for pieces (row, length <= room), with no
    two pieces of one row number."""
    whole = cut.where(F.col("length") == room).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = cut.where(F.col("length") < room).select("row", "length")
    sealed, turn, n = whole, 0, left.count()
    groups = -(-n // group)
    while n:
        done = staged(
            left.withColumn("_group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)).cast("int"))
            .repartitionById(groups, "_group")  # a task each: few bytes, which would else be one task's
            .groupBy("_group").applyInPandas(
                _pack_round(turn, room), "row long, length long, sequence_id long, offset long, open boolean"),
            "packed")
        rest = done.where("open")
        n, tokens, bins = rest.agg(F.count(F.lit(1)), F.sum("length"), F.countDistinct("sequence_id")).first()
        if groups == 1 or not n or bins == -(-tokens // room):
            return sealed.union(done.select("row", "sequence_id", "offset"))
        sealed = sealed.union(done.where("not open").select("row", "sequence_id", "offset"))
        left, turn = rest.select("row", "length"), turn + 1
        groups = min(-(-n // group), -(-groups // 2))
    return sealed


def packed_sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     vocabulary: str = VOCABULARY, room: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and its place."""
    cut = staged(pieces(docs, id_col, text_col, vocabulary, room)
                 .withColumn("row", F.monotonically_increasing_id()), "pieces")
    return cut.join(pack(cut, room, group), "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_sequences(table(spark, sf_dir, "documents"))
