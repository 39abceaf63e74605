"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes.  A byte costs
-log2 of its share in the longest context that has seen it; each longer known
context that has not costs an escape (method C: with T bytes and D different
ones seen, a byte seen n times has n / (T + D), the escape D / (T + D)).  Below
the empty context all 256 bytes are alike.  The statistics are frozen after
training, so a text's cost in a language is an exact code length, and the
language with the shortest one, with -log2 of its share of the training texts
added, is predicted.  The score is the posterior of that language.

All training texts are counted: tasks count four-byte windows by language, Spark
adds the counts up, and the shorter contexts are their marginals.  No count is
cut.  The counts stay a table, dealt by the two middle bytes of a window: with
them lie all windows, contexts and shorter windows that its costs depend on, but
for contexts of one byte and none, which every task has (65,536 windows a
language at most).  Each task builds the trees of its part and gives the distinct
windows of the texts their costs.  The most frequent windows, of ``cells``
(window, language) costs at most, are sent to the tasks that read the texts; the
other windows of a text are kept aside by count, joined with the table of costs,
and added up.  So every text has its exact code lengths at any size.

Texts are lower-cased.  Before its first byte a text has the context of zero
bytes.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
a null id is predicted and never used in training; rows with a null language are
predicted only; repeated rows are predicted one by one.  Without any training
text everything is ``und`` with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import id_remainder, rows_of, staged, table

ORDER = 3
#: (window, language) costs that are sent to the tasks, at most: 16 MB.
CELLS = 4_000_000
#: Rows (window, language) of counts that one task builds trees of, about.
PART = 1_000_000
_LETTER = re.compile(r"[^\W\d_]")


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The window of each byte of the texts in a row (the byte and the three
    before it, the byte lowest), and the bounds of the texts."""
    pad = b"\0" * ORDER
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"".join(pad + r for r in raw) or pad, np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ends = len(b) - ORDER
    codes = b[ORDER:].astype(np.uint32)
    for k in range(1, ORDER + 1):
        codes |= b[ORDER - k:len(b) - k].astype(np.uint32) << np.uint32(8 * k)
    starts = bounds[:-1] + ORDER * np.arange(len(raw))
    inside = np.ones(ends, bool)
    for k in range(1, ORDER + 1):
        between = starts[1:] - k
        inside[between] = False
    return codes[inside], bounds


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of each task, handed on whenever there are many."""
    seen: dict[str, list] = {}

    def flush(lang: str) -> pa.RecordBatch:
        keys, n = _merged(seen.pop(lang))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())],
            names=["lang", "gram", "n"])

    for block in rows_of(batches):
        texts: dict[str, list[str]] = {}
        for lang, text in block:
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            codes, _ = windows(own)
            parts = seen.setdefault(lang, [])
            parts.append(np.unique(codes, return_counts=True))
            if len(parts) > 8:
                parts[:] = [_merged(parts)]
                if len(parts[0][0]) > 500_000:
                    yield flush(lang)
    for lang in list(seen):
        yield flush(lang)


class Index:
    """Rows of sorted distinct 32-bit keys: a table addressed by a hash, and a
    search for the keys that found their place taken."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint32(0)).astype(np.uint32)
        bits = max(4, int(np.ceil(np.log2(max(1, 4 * len(keys))))))
        self.shift = np.uint32(32 - bits)
        self.rows = np.full(1 << bits, len(keys), np.int32)
        place = self._place(keys)
        _, first = np.unique(place, return_index=True)
        self.rows[place[first]] = first
        other = np.ones(len(keys), bool)
        other[first] = False
        self.spare = np.flatnonzero(other)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint32) * np.uint32(2654435769)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        rows = self.rows[self._place(keys)]
        missing = np.flatnonzero((self.keys[rows] != keys) | (rows == len(self.keys) - 1))
        if len(missing):
            want = keys[missing]
            got = np.full(len(missing), -1, np.int32)
            if len(self.spare):
                spare = self.keys[self.spare]
                at = np.minimum(np.searchsorted(spare, want), len(spare) - 1)
                got = np.where(spare[at] == want, self.spare[at], -1).astype(np.int32)
            rows[missing] = got
        return rows


@dataclass
class Trees:
    """langs; by order: windows and their costs (backed off where a language has
    not seen them), contexts and the cost of their escape (0 where a language
    does not know the context)."""

    langs: list[str]
    grams: list[np.ndarray] = field(default_factory=list)
    costs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)

    def add(self, lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> None:
        """The next longer order, from counts of windows by language."""
        grams, row = np.unique(gram.astype(np.uint32), return_inverse=True)
        contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
        count = np.zeros((len(grams), len(self.langs)))
        np.add.at(count, (row, lang), n)
        total, kinds = np.zeros((len(contexts), len(self.langs))), np.zeros((len(contexts), len(self.langs)))
        np.add.at(total, of, count)
        np.add.at(kinds, of, count > 0)
        known = total > 0
        escape = np.log2(np.where(known, (total + kinds) / np.where(known, kinds, 1.0), 1.0))
        lower = self.cost(grams, len(self.grams) - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.log2((total + kinds)[of] / count)
        self.costs.append(np.where(count > 0, own, escape[of] + lower).astype(np.float32))
        self.grams.append(grams)
        self.contexts.append(contexts.astype(np.uint32))
        self.escapes.append(escape.astype(np.float32))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _index(self, kind: str, order: int) -> Index:
        cached = self.__dict__.setdefault("_indexes", {})
        keys = getattr(self, kind)[order]
        if (kind, order) not in cached:
            cached[kind, order] = Index(keys)
        return cached[kind, order]

    def cost(self, codes: np.ndarray, order: int) -> np.ndarray:
        """Cost of the last byte of each window in each language, with contexts
        of up to ``order`` bytes."""
        if order < 0:
            return np.full((len(codes), len(self.langs)), 8.0, np.float32)
        own = codes & np.uint32((1 << 8 * (order + 1)) - 1)
        row = self._index("grams", order).find(own)
        out = self.costs[order][row] if len(self.grams[order]) else np.empty((len(codes), len(self.langs)), np.float32)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            at = self._index("contexts", order).find(own[missing] >> np.uint32(8))
            out[missing] = self.cost(codes[missing], order - 1)
            known = at >= 0
            out[missing[known]] += self.escapes[order][at[known]]
        return out


@dataclass
class Profiles:
    """langs; prior: cost of each language; low: the trees of contexts of no and
    one byte; counts: (lang, gram, n) of all training texts."""

    langs: list[str]
    prior: np.ndarray
    low: Trees
    counts: DataFrame


def _low(order: int) -> int:
    return (1 << 8 * (order + 1)) - 1


def train(texts: DataFrame) -> Profiles | None:
    """Profiles from all rows of ``texts`` (lang, text), none null."""
    share = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return None
    langs = sorted(share)
    place = {x: i for i, x in enumerate(langs)}
    counts = texts.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    counts = staged(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    low = Trees(langs)
    for order in (0, 1):
        # no more rows than 65,536 a language
        found = counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(_low(order)).cast("long")).alias("gram")) \
            .agg(F.sum("n").alias("n")).toArrow()
        low.add(np.array([place[x] for x in found["lang"].to_pylist()], np.int64),
                found["gram"].to_numpy(), found["n"].to_numpy())
    return Profiles(langs, -np.log2(np.array([share[x] for x in langs], float) / sum(share.values())), low, counts)


def window_costs(texts: DataFrame, profiles: Profiles) -> DataFrame:
    """(gram, times, cost by language) of every distinct window of ``texts``
    (text)."""
    langs, low = profiles.langs, profiles.low
    place = {x: i for i, x in enumerate(langs)}
    wanted = texts.where("text is not null").select(F.lit("").alias("lang"), "text") \
        .mapInArrow(_count, "lang string, gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-profiles.counts.count() // PART))
    both = profiles.counts.select("gram", "n", "lang").unionByName(
        wanted.select("gram", "n", F.lit(None).cast("string").alias("lang")))
    dealt = both.repartition(parts, F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF).cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("gram", pa.int64()), ("n", pa.int64()), ("lang", pa.string())]))
        gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
        lang = np.array([-1 if x is None else place[x] for x in rows["lang"].to_pylist()], np.int64)
        trees = Trees(langs, *(list(getattr(low, k)) for k in ("grams", "costs", "contexts", "escapes")))
        seen = lang >= 0
        for order in range(2, ORDER + 1):
            trees.add(lang[seen], gram[seen] & _low(order), n[seen])
        gram, n = gram[~seen], n[~seen]
        for at in range(0, len(gram), 100_000):
            own = gram[at:at + 100_000]
            cost = trees.cost(own.astype(np.uint32), ORDER)
            bounds = pa.array(np.arange(len(own) + 1) * len(langs), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(n[at:at + 100_000]), pa.ListArray.from_arrays(bounds, pa.array(cost.ravel()))],
                names=["gram", "times", "cost"])

    return dealt.mapInArrow(run, "gram long, times long, cost array<float>")


def _head(costs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent windows and their costs, ``most`` windows at most."""
    sizes = sorted((r["size"], r["grams"]) for r in costs.groupBy(F.floor(F.log2("times")).alias("size"))
                   .agg(F.count(F.lit(1)).alias("grams")).collect())
    least, kept = 0, sum(g for _, g in sizes)
    for size, g in sizes:
        if kept <= most:
            break
        least, kept = size + 1, kept - g
    found = costs.where(F.col("times") >= (1 << least)).select("gram", "cost").toArrow().combine_chunks()
    gram = found["gram"].to_numpy()
    flat = found["cost"].combine_chunks() if len(gram) else None
    cost = np.asarray(flat.flatten(), np.float32).reshape(len(gram), -1) if len(gram) else np.zeros((0, 1), np.float32)
    order = np.argsort(gram)
    return gram[order].astype(np.uint32), cost[order]


def code_lengths(rows: DataFrame, profiles: Profiles, cells: int = CELLS) -> DataFrame:
    """Rows (doc_id, text) as (doc_id, bits): bits of the text in each language
    and of the language; null for a text without a letter."""
    langs = profiles.langs
    costs = staged(window_costs(rows.select("text"), profiles), "costs")
    shared = rows.sparkSession.sparkContext.broadcast(  # bounded by ``cells``
        (_head(costs, max(1, cells // len(langs))), profiles.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (grams, cost), prior = shared.value
        index = Index(grams)
        cost = np.vstack([cost.reshape(len(grams), -1), np.zeros((1, len(prior)), np.float32)]) if len(grams) \
            else np.zeros((1, len(prior)), np.float32)
        for block in rows_of(batches, 1_000_000):
            mine = np.array([bool(r[1] and _LETTER.search(r[1])) for r in block])
            codes, bounds = windows([r[1] if kept else "" for r, kept in zip(block, mine)])
            bits, full = np.tile(prior, (len(block), 1)), np.flatnonzero(np.diff(bounds))
            rare = np.zeros((2, 0), np.int64)
            if len(full):
                at = index.find(codes)  # -1: the last row, of zeros
                bits[full] += np.add.reduceat(cost[at], bounds[full], axis=0, dtype=np.float64)
                missing = np.flatnonzero(at < 0)
                of = np.repeat(np.arange(len(block)), np.diff(bounds))[missing]
                rare = np.stack(np.unique((of.astype(np.uint64) << np.uint64(32)) | codes[missing], return_counts=True)).astype(np.int64)
            found = pa.StructArray.from_arrays([pa.array(rare[0] & 0xFFFFFFFF), pa.array(rare[1])], names=["gram", "times"])
            ends = np.searchsorted(rare[0] >> 32, np.arange(len(block) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in block], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1) * len(prior), pa.int32()), pa.array(bits.ravel()),
                                          mask=pa.array(~mine)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], names=["doc_id", "bits", "rare"])

    first = staged(rows.mapInArrow(run, "doc_id long, bits array<double>, rare array<struct<gram:long,times:long>>")
                   .withColumn("row", F.monotonically_increasing_id()), "bits")
    more = first.select("row", F.inline("rare")).join(costs.select("gram", "cost"), "gram").groupBy("row").agg(
        F.array(*(F.sum(F.col("times") * F.col("cost")[i].cast("double")) for i in range(len(langs)))).alias("more"))
    return first.drop("rare").join(more, "row", "left").select(
        "doc_id", F.when(F.col("more").isNull(), F.col("bits")).otherwise(
            F.zip_with("bits", "more", lambda a, b: a + b)).alias("bits"))


def predicted(docs: DataFrame, profiles: Profiles | None, id_col: str = "doc_id", text_col: str = "text",
              cells: int = CELLS) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if profiles is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    bits, best = F.col("bits"), F.array_min("bits")
    weight = F.aggregate(bits, F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), F.greatest(best - b, F.lit(-1000.0))))
    return code_lengths(rows, profiles, cells).select(
        "doc_id",
        F.when(bits.isNull(), "und").otherwise(
            F.array(*map(F.lit, profiles.langs))[F.array_position(bits, best).cast("int") - 1]).alias("lang_pred"),
        F.when(bits.isNull(), 0.0).otherwise(1 / weight).alias("score"))


def op7_ppm_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = id_remainder(F.col("doc_id"), 4) == 2
    known = docs.where(F.col("doc_id").isNotNull() & ~held & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predicted(docs, train(known.select("lang", "text"))).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")
