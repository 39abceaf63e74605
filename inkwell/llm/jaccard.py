"""Similarity join on word n-grams by parity sketches.

A document's set is its distinct 5-word shingles, as 64-bit hashes.  Sets A and
B are linked at Jaccard >= 0.8, which is |A ^ B| <= (|A| + |B|) / 9 for their
symmetric difference.  Sketches bound that difference from below, so no link
is lost before it is verified on the sets:

* *Parity words.*  In the scheme of a size band, elements are dealt to k blocks
  by hash and the hashes in a block are XORed.  Blocks that differ are at most
  as many as elements that differ.  A pair is compared in the band of its larger
  member; a document takes part in its own band and in that of 1.25 times its
  size.  With at most d differing blocks, pigeonhole leaves an equal one among
  the first d + 1 of each side in any common order.  The order here puts blocks
  of many elements first: they are the selective ones, while the blocks that
  hold one shingle of a passage that everybody quotes come last and are not
  used.  Blocks without elements are no evidence; a document with so many of
  them that they could be the only agreement (both partners are such then) is
  entered again under the next seed.
* *Parity bits.*  One bit per element is flipped in a sketch of four to eight
  bits per element.  Its Hamming distance, too, is at most the difference, and
  rejects nearly all false candidates before any set is moved.

Equal sets are one node, so a group of exact copies costs one document.  Near
copies that share a bucket are not paired all with all: in a few rounds every
member is compared with a hub of its bucket, the links found join components,
and buckets within one component are dropped.  Only then are the pairs of
different components that still share a bucket compared, all of them.  So the
components are exact, though not every link inside one is looked at.

Defined results: a document without words or text has size 0 and is its own
component; a null id has a null component and links with nothing; rows that
repeat an id are one node with the sets of all of them; repeated rows give
repeated result rows.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwell.llm.common import ascii_words, mix64, rows_of, staged, table
from inkwell.llm.components import components

WORDS = 5
#: Similarity of a link, as a fraction; the differences allowed follow from it.
PART, WHOLE = 80, 100
_LEAST = 4  # two different sets below this size are never similar enough
_RATIO = 1.6
_SEEDS = 8
_HUB_ROUNDS = 3
#: Characters of text that are words, hashes and bucket keys at once.
_BLOCK = 1_000_000
_U = np.uint64


def _bands(upto: int = 1 << 40) -> np.ndarray:
    """First sizes of the bands."""
    at = [_LEAST]
    while at[-1] < upto:
        at.append(max(at[-1] + 1, int(np.ceil(at[-1] * _RATIO))))
    return np.array(at, np.int64)


_BANDS = _bands()


def _differences(total):
    """Largest symmetric difference of a link between sets of ``total`` elements
    in all."""
    return total * (WHOLE - PART) // (WHOLE + PART)


class _WordHash(dict):
    """64-bit hash of each word; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 100_000:
            self.clear()
        self[word] = value
        return value


def shingle_sets(texts: list[str | None], cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and their bounds."""
    docs = [ascii_words(t) for t in texts]
    sizes = np.array([len(d) for d in docs], np.int64)
    ends = np.cumsum(sizes)
    word = np.fromiter((cache[w] for d in docs for w in d), _U, int(ends[-1]) if len(ends) else 0)
    n = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    start = ends - sizes
    place = np.repeat(start - bounds[:-1], n) + np.arange(bounds[-1])
    out = np.zeros(bounds[-1], _U)
    reach = np.minimum(np.repeat(sizes, n), WORDS)
    step = _U(0x9E3779B97F4A7C15)
    for j in range(WORDS):
        inside = reach > j
        out[inside] = (out[inside] * step) + word[(place + j)[inside]]
    out = mix64(out + reach.astype(_U))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][n > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])[bounds]
    return out[fresh], kept


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(_U).view(np.int64), pa.int64())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, f, g): set size and 128 bits that tell sets apart."""
    cache = _WordHash()
    for block in rows_of(batches, _BLOCK):
        s, bounds = shingle_sets([r[1] for r in block], cache)
        n = np.diff(bounds)
        f, g = np.zeros(len(n), _U), np.zeros(len(n), _U)
        full = np.flatnonzero(n)
        if len(full):
            f[full] = np.add.reduceat(s, bounds[full])
            g[full] = np.bitwise_xor.reduceat(mix64(s ^ _U(0x5851F42D4C957F2D)), bounds[full])
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in block], pa.int64()), pa.array(n, pa.int64()), _long(f), _long(g)],
            names=["doc_id", "n", "f", "g"])


def _scheme_keys(s, bounds, rows, band, allowed, seed):
    """Bucket keys of the documents ``rows`` in the schemes ``band``, given the
    differences ``allowed`` to each: (document row, key) arrays, and which of
    the documents need another seed."""
    most = _differences(2 * (_BANDS[band + 1] - 1))
    k = (5 * (most + 1) + 3) // 4 + 1
    first = np.concatenate([[0], np.cumsum(k)])
    size = bounds[rows + 1] - bounds[rows]
    which = np.repeat(np.arange(len(rows)), size)
    at = np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
    element = mix64(s[at] + mix64(np.array([seed + 1], _U)))
    block = first[which] + ((element >> _U(32)) % k[which].astype(_U)).astype(np.int64)
    word = np.zeros(first[-1], _U)
    np.bitwise_xor.at(word, block, element)
    count = np.bincount(block, minlength=first[-1])
    place = np.arange(first[-1]) - np.repeat(first[:-1], k)
    salt = mix64((np.repeat(band, k).astype(_U) << _U(40)) + place.astype(_U) + (_U(seed) << _U(56)))
    key = (_U(31) - np.minimum(count, 31).astype(_U) << _U(59)) | (mix64(word ^ salt) >> _U(5))
    key[count == 0] = _U(0xFFFFFFFFFFFFFFFF)  # sorted last
    empty = np.add.reduceat(count == 0, first[:-1]) if len(rows) else np.zeros(0, int)
    used = np.minimum(allowed + 1, k - empty)
    for a, b in zip(first[:-1], first[1:]):
        key[a:b].sort()
    taken = place < np.repeat(used, k)
    return np.repeat(np.arange(len(rows)), k)[taken], key[taken], empty >= k - allowed


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id): the buckets that each document is entered in."""
    cache = _WordHash()
    for block in rows_of(batches, _BLOCK):
        s, bounds = shingle_sets([r[1] for r in block], cache)
        n = np.diff(bounds)
        largest = n * WHOLE // PART
        own = np.searchsorted(_BANDS, n, "right") - 1
        above = np.searchsorted(_BANDS, largest, "right") - 1
        ids = np.array([r[0] for r in block], np.int64)
        rows = np.flatnonzero(n >= _LEAST)
        up = rows[above[rows] > own[rows]]
        band = np.concatenate([own[rows], above[up]])
        partner = np.concatenate([np.minimum(largest[rows], _BANDS[own[rows] + 1] - 1), largest[up]])
        rows = np.concatenate([rows, up])
        allowed = _differences(n[rows] + partner)
        for seed in range(_SEEDS):
            if not len(rows):
                break
            which, key, again = _scheme_keys(s, bounds, rows, band, allowed, seed)
            yield pa.RecordBatch.from_arrays([_long(key), pa.array(ids[rows[which]], pa.int64())], names=["key", "id"])
            rows, band, allowed = rows[again], band[again], allowed[again]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, bits, elements): parity bits and the set itself."""
    cache = _WordHash()
    for block in rows_of(batches, _BLOCK):
        s, bounds = shingle_sets([r[1] for r in block], cache)
        n = np.diff(bounds)
        words = 1 << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / 16.0)).astype(np.int64))
        first = np.concatenate([[0], np.cumsum(words)])
        which = np.repeat(np.arange(len(n)), n)
        bit = mix64(s ^ _U(0xA0761D6478BD642F))
        place = first[which] + ((bit >> _U(6)) % words[which].astype(_U)).astype(np.int64)
        sketch = np.zeros(first[-1], _U)
        np.bitwise_xor.at(sketch, place, _U(1) << (bit & _U(63)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in block], pa.int64()), pa.array(n, pa.int64()),
             pa.ListArray.from_arrays(pa.array(first, pa.int32()), _long(sketch)),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _long(s))],
            names=["id", "n", "bits", "elements"])


def _distance(a: Column, b: Column) -> Column:
    """Hamming distance of two bit sketches; the longer one, of twice the
    length, is folded onto the shorter."""
    def folded(x: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(x) > half, F.zip_with(
            F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    return F.aggregate(
        F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
        F.lit(0), lambda x, y: x + y)


def _possible(a: str, b: str) -> Column:
    """Sizes and sketches of two documents allow a link."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (WHOLE * small >= PART * large) & (
        _distance(F.col(f"{a}.bits"), F.col(f"{b}.bits")) * (WHOLE + PART)
        <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (WHOLE - PART))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
    common = both.select("a", "b", (F.size("x") + F.size("y")).alias("total"),
                         F.size(F.array_intersect("x", "y")).alias("common"))
    return common.where(f"{WHOLE} * common >= {PART} * (total - common)").select("a", "b")


def links_between(texts: DataFrame) -> DataFrame:
    """(node, component) of the linked documents among ``texts`` (id, text),
    whose sets differ."""
    entered = texts.mapInArrow(_buckets, "key long, id long")
    same = Window.partitionBy("key")
    buckets = staged(
        entered.withColumn("lo", F.min("id").over(same)).withColumn("hi", F.max("id").over(same))
        .where("lo < hi").select("key", "id"), "buckets")
    shared = staged(buckets.groupBy("id").agg(F.count(F.lit(1)).alias("shared")), "shared")
    sets = staged(texts.join(shared.select("id"), "id", "left_semi").mapInArrow(
        _sketches, "id long, n long, bits array<long>, elements array<long>"), "sets")
    sketches = sets.select("id", "n", "bits")
    open_rows = buckets.join(shared, "id").select("key", "id", F.col("id").alias("comp"), "shared")
    found, labels = None, None
    for turn in range(_HUB_ROUNDS + 1):
        if turn < _HUB_ROUNDS:
            # the first hubs are the documents that share most, then any
            rank = F.struct(F.col("shared") if turn == 0 else F.xxhash64("id", F.lit(turn)), "id")
            hubs = open_rows.groupBy("key").agg(F.max_by(F.struct("id", "comp"), rank).alias("hub"))
            pairs = (open_rows.join(hubs, "key").where("comp <> hub.comp")
                     .select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()
                     .join(sketches.select(F.col("id").alias("a"), F.struct("n", "bits").alias("p")), "a")
                     .join(sketches.select(F.col("id").alias("b"), F.struct("n", "bits").alias("q")), "b")
                     .where(_possible("p", "q"))
                     .groupBy("b").agg(F.min_by("a", F.struct(_distance(F.col("p.bits"), F.col("q.bits")), "a")).alias("a")))
        else:
            full = open_rows.join(sketches, "id")
            x, y = full.alias("p"), full.alias("q")
            pairs = x.join(y, (F.col("p.key") == F.col("q.key")) & (F.col("p.id") < F.col("q.id"))
                           & (F.col("p.comp") != F.col("q.comp")) & _possible("p", "q")) \
                .select(F.col("p.id").alias("a"), F.col("q.id").alias("b")).distinct()
        links = _verified(pairs, sets)
        found = staged(links if found is None else found.union(links.select("a", "b")), "links")
        labels = components(found)
        if turn < _HUB_ROUNDS:
            known = open_rows.drop("comp").join(labels, F.col("id") == F.col("node"), "left") \
                .select("key", "id", F.coalesce("component", "id").alias("comp"), "shared")
            open_rows = staged(
                known.withColumn("lo", F.min("comp").over(same)).withColumn("hi", F.max("comp").over(same))
                .where("lo < hi").drop("lo", "hi"), "open")
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = staged(texts.mapInArrow(_fingerprints, "doc_id long, n long, f long, g long"), "prints")
    classes = prints.where("n > 0 and doc_id is not null").groupBy("n", "f", "g").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("members"))
    classes = staged(classes, "classes")
    copies = prints.join(classes.where("members > 1"), ["n", "f", "g"]).where("doc_id <> node").select("doc_id")
    barred = copies.union(prints.where(f"n < {_LEAST}").select("doc_id")).distinct() \
        .join(classes.where(f"n >= {_LEAST}").select(F.col("node").alias("doc_id")), "doc_id", "left_anti")
    distinct = texts.where("doc_id is not null").join(barred, "doc_id", "left_anti") \
        .select(F.col("doc_id").alias("id"), "text")
    labels = links_between(distinct)
    known = classes.join(labels.withColumnRenamed("component", "reached"), "node", "left") \
        .select("n", "f", "g", F.coalesce("reached", "node").alias("component_id"))
    return prints.join(known, ["n", "f", "g"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op5_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
