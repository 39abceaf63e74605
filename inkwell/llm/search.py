"""Ranked lexical search with hashed max-sketches.

A document's impact of a term grows with the term's frequency tf in it, and its
score for a query sums weight times impact over the query's terms.  A sketch
folds the impacts of a document into ``ROWS`` arrays of coordinates: a term
falls on one coordinate of each row by its hash, and a coordinate keeps the
maximum.  The least of a term's coordinates is never below its impact and is 0
for most terms that the document lacks, so the sum of weight times that is an
upper bound of the score.  For one document the impact is a growing function of
tf, so coordinates hold tf (255 stands for any higher one, bounded by the limit
of the impact): exact, one byte, and independent of the rest of the corpus; an
index grows by appending.  A sketch has at least ``SLOTS`` coordinates a row for
each distinct term, so long documents have bounds as tight as short ones.

Searching a block of queries:

1. document frequencies of the queries' terms, over all texts;
2. upper bounds of all documents by batched look-ups in the sketches, the
   highest ``k`` a query give documents that are scored exactly: the k-th best
   of these scores is a first threshold;
3. bounds again; in descending order of their bounds, documents are scored
   exactly until the next bound is below the threshold, which rises to the k-th
   best score so far.  A task returns at most k rows a query.

Nothing below the threshold can enter the result and nothing above it is left
out: the ranks are exact.

Scale: the index is a written table.  The text of a document is cut into terms
once for the index, once a block for the frequencies, and again only where a
bound asks for it.  Queries (about ``BLOCK_BYTES`` of their texts at a time) are
broadcast, documents never move, and what is shuffled is k rows a query and
task at most.

Defined results: a document is a row; null and empty texts have no terms and
are never ranked; a null id comes after all others among equal scores; queries
without terms or id have no rows; rows that share a query id are one query with
the terms of each; without documents there are no rows; other columns of the
inputs are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import ascii_terms, mix64, rows_of, staged, table, text_blocks

#: Sketch rows, and coordinates of a row for each distinct term.
ROWS = 2
SLOTS = 4

#: Bytes of query texts that are searched at a time; characters of documents and
#: bytes of sketches that a task holds at a time.
BLOCK_BYTES = 200_000
PIECE = 2_000_000

#: Fixed values of the score: the share of the length norm, the saturation, and
#: the scale; an impact is always below SCALE // 1000.
SCALE = 1_000_000_000


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n_terms: int, n_docs: int, total: int) -> int:
    return 50 + 50 * n_terms * n_docs // total


def impact(tf: int, norm: int) -> int:
    return SCALE * tf // (1000 * tf + 20 * norm)


def _hashes(terms: list[bytes]) -> np.ndarray:
    """Hash of each term in each sketch row, (ROWS, terms)."""
    h = mix64(np.array([zlib.crc32(t) for t in terms], dtype=np.uint64) + np.uint64(1 << 32))
    return np.stack([h >> np.uint64(32 * r) & np.uint64(0xFFFFFFFF) for r in range(ROWS)]).astype(np.int64)


def sketch(counts: dict[bytes, int]) -> bytes:
    """The max-sketch of a document's term frequencies."""
    width = 1 << max(4, (SLOTS * len(counts) - 1).bit_length())
    cells = np.zeros((ROWS, width), dtype=np.uint8)
    tf = np.minimum(np.fromiter(counts.values(), dtype=np.int64, count=len(counts)), 255).astype(np.uint8)
    for row, h in zip(cells, _hashes(list(counts))):
        np.maximum.at(row, h & (width - 1), tf)
    return cells.tobytes()


def build_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sketch, text) of the documents with a term, written to the
    shared folder; n is the number of terms with repeats."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("text", pa.string())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, PIECE):
            out = []
            for doc_id, text in rows:
                counts = Counter(ascii_terms(text))
                if counts:
                    out.append((doc_id, counts.total(), sketch(counts), text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                  .mapInArrow(build, "doc_id long, n long, sketch binary, text string"), "search-index")


class Queries:
    """A block of queries: their terms with weights, and look-ups of bounds."""

    def __init__(self, items: list[tuple[str, str]]):
        terms: dict[str, set[bytes]] = {}
        for item, text in items:
            if found := ascii_terms(text):
                terms.setdefault(item, set()).update(found)
        self.ids = sorted(terms)
        self.terms = [sorted(terms[i]) for i in self.ids]
        self.floor = [1] * len(self.ids)

    def vocabulary(self) -> set[bytes]:
        return {t for terms in self.terms for t in terms}

    def weigh(self, n_docs: int, total: int, df: dict[bytes, int]) -> None:
        self.n_docs, self.total = n_docs, total
        self.weighted = [[(t, weight(n_docs, df[t])) for t in terms if t in df] for terms in self.terms]
        entries = [(q, t, w) for q, terms in enumerate(self.weighted) for t, w in terms]
        self.at = np.array([q for q, _, _ in entries], dtype=np.int64)
        self.weights = np.array([w for _, _, w in entries], dtype=np.float64)
        self.hashes = _hashes([t for _, t, _ in entries])

    def norms(self, n: np.ndarray) -> np.ndarray:
        return np.array([length_norm(int(x), self.n_docs, self.total) for x in n], dtype=np.int64)

    def bounds(self, sketches: list[bytes], norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, (documents, queries).  Sketches of one
        width are looked up together.  Quotients in floating point are never
        below those rounded down; the 1 covers the rounding of the sum."""
        out = np.zeros((len(sketches), len(self.ids)))
        widths = np.array([len(s) // ROWS for s in sketches])
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            for part in np.array_split(own, -(-len(own) * len(self.at) // 16_000_000) or 1):
                cells = np.frombuffer(b"".join(sketches[i] for i in part), dtype=np.uint8).reshape(len(part), ROWS, width)
                tf = cells[:, 0].take(self.hashes[0] & (width - 1), axis=1)
                for r in range(1, ROWS):
                    np.minimum(tf, cells[:, r].take(self.hashes[r] & (width - 1), axis=1), out=tf)
                d, e = np.nonzero(tf)
                f = tf[d, e].astype(np.float64)
                most = np.where(f < 255, SCALE * f / (1000 * f + 20 * norms[part][d]), SCALE / 1000)
                sums = np.bincount(d * len(self.ids) + self.at[e], most * self.weights[e], len(part) * len(self.ids))
                out[part] = np.ceil(sums + (sums > 0)).reshape(len(part), -1)
        return out

    def score(self, q: int, counts: dict[bytes, int], norm: int) -> int:
        return sum(w * impact(tf, norm) for t, w in self.weighted[q] if (tf := counts.get(t)))


def _statistics(index: DataFrame, vocabulary: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents, terms with repeats, and the document frequencies of the
    vocabulary.  A task adds up its own counts first."""
    n_docs, total = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    words = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for rows in rows_of(batches, PIECE):
            for (text,) in rows:
                found.update(words.value.intersection(ascii_terms(text)))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.binary()),
                                          "df": pa.array(list(found.values()), pa.int64())})

    counted = index.select("text").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return n_docs, total or 0, {bytes(r.term): r.df for r in counted.collect()}


def _highest_bounds(index: DataFrame, queries, k: int) -> DataFrame:
    """(q, doc_id) of the k highest bounds a query."""
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        best: list[list[tuple]] = [[] for _ in block.ids]
        for rows in rows_of(batches, PIECE):
            bounds = block.bounds([r[2] for r in rows], block.norms([r[1] for r in rows]))
            for q, heap in enumerate(best):
                column = bounds[:, q]
                least = heap[0][0] if len(heap) == k else 0
                chosen = np.flatnonzero(column > least)
                for i in chosen[np.argsort(-column[chosen], kind="stable")][:k]:
                    if len(heap) < k:
                        heapq.heappush(heap, (column[i], rows[i][0]))
                    elif column[i] > heap[0][0]:
                        heapq.heapreplace(heap, (column[i], rows[i][0]))
        flat = [(q, d, b) for q, heap in enumerate(best) for b, d in heap]
        yield pa.RecordBatch.from_pydict({"q": pa.array([x[0] for x in flat], pa.int32()),
                                          "doc_id": pa.array([x[1] for x in flat], pa.int64()),
                                          "bound": pa.array([x[2] for x in flat], pa.float64())})

    found = index.where("doc_id is not null").select("doc_id", "n", "sketch").mapInArrow(
        look_up, "q int, doc_id long, bound double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bound"), "doc_id"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("q", "doc_id").distinct()


def _rank(scored: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return scored.withColumn("rank", place).where(F.col("rank") <= k)


def _score_seeds(index: DataFrame, seeds: DataFrame, queries) -> DataFrame:
    """(q, doc_id, score) of documents chosen by their bounds (at most k a
    query, so their list is as bounded as the block)."""
    asked = F.broadcast(seeds.groupBy("doc_id").agg(F.collect_list("q").alias("qs")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        for rows in rows_of(batches, PIECE):
            out = []
            for doc_id, n, qs, text in rows:
                counts, norm = Counter(ascii_terms(text)), length_norm(n, block.n_docs, block.total)
                out += [(q, doc_id, block.score(q, counts, norm)) for q in qs]
            yield pa.RecordBatch.from_pydict({"q": pa.array([x[0] for x in out], pa.int32()),
                                              "doc_id": pa.array([x[1] for x in out], pa.int64()),
                                              "score": pa.array([x[2] for x in out], pa.int64())})

    return index.join(asked, "doc_id").select("doc_id", "n", "qs", "text").mapInArrow(score, "q int, doc_id long, score long")


def _search(index: DataFrame, queries, k: int) -> DataFrame:
    """(q, doc_id, score): at most k rows a query and task, all rows of the
    result among them."""
    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = queries.value
        # the worst of the best is first: lowest score, of these the highest id (none: above all)
        best: list[list[tuple]] = [[] for _ in block.ids]
        for rows in rows_of(batches, PIECE):
            norms = block.norms([r[1] for r in rows])
            bounds = block.bounds([r[2] for r in rows], norms)
            counted: dict[int, Counter] = {}
            for q, heap in enumerate(best):
                least = max(block.floor[q], heap[0][0] if len(heap) == k else 0)
                column = bounds[:, q]
                chosen = np.flatnonzero(column >= least)
                for i in chosen[np.argsort(-column[chosen], kind="stable")].tolist():
                    if column[i] < least:
                        break
                    if i not in counted:
                        counted[i] = Counter(ascii_terms(rows[i][3]))
                    score = block.score(q, counted[i], int(norms[i]))
                    if score < least:
                        continue
                    doc_id = rows[i][0]
                    entry = (score, -math.inf if doc_id is None else -doc_id)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        least = max(least, heap[0][0])
        flat = [(q, None if d == -math.inf else -d, s) for q, heap in enumerate(best) for s, d in heap]
        yield pa.RecordBatch.from_pydict({"q": pa.array([x[0] for x in flat], pa.int32()),
                                          "doc_id": pa.array([x[1] for x in flat], pa.int64()),
                                          "score": pa.array([x[2] for x in flat], pa.int64())})

    return index.select("doc_id", "n", "sketch", "text").mapInArrow(rescore, "q int, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id as string, rank, doc_id, score): the k highest-scoring documents
    of :func:`build_index` for each query of ``items`` (item_id, text)."""
    spark = index.sparkSession
    ranked = []
    for rows in text_blocks(items, "item_id", block_bytes):
        block = Queries(rows)
        if not block.ids:
            continue
        block.weigh(*_statistics(index, block.vocabulary()))
        shared = spark.sparkContext.broadcast(block)
        first = _rank(_score_seeds(index, _highest_bounds(index, shared, k), shared), k)
        for r in first.where(F.col("rank") == k).select("q", "score").collect():
            block.floor[r.q] = max(1, r.score)
        shared.unpersist()
        ids = F.array(*[F.lit(i) for i in block.ids])
        found = _rank(_search(index, spark.sparkContext.broadcast(block), k), k)
        ranked.append(found.select(F.get(ids, F.col("q")).alias("item_id"), "rank", "doc_id", "score"))
    if not ranked:
        return spark.createDataFrame([], "item_id string, rank int, doc_id long, score long")
    result = ranked[0]
    for more in ranked[1:]:
        result = result.union(more)
    return result


def op11_max_sketch_search(spark, sf_dir: str) -> DataFrame:
    found = search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), 50)
    return found.withColumn("item_id", F.col("item_id").cast("long"))


#: Scores every document that shares a term with an item.
ORACLE_OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
c AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, c GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 50 + (50 * len(w) * n_docs) // total AS m FROM d, c WHERE len(w) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL),
s AS (
  SELECT item_id, doc_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN m USING (r) GROUP BY ALL),
k AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50"""
