"""Near-duplicate vectors by iterative quantisation and multi-index hashing.

Binary codes: a bounded sample gives the mean, the principal directions and, by
alternating between signs and a Procrustes rotation, the rotation whose signs
lose least (Gong and Lazebnik, *Iterative Quantization*); the median of each
rotated coordinate is its threshold, so that every bit is balanced.  All rows
are coded and indexed.

Retrieval: a code is cut into tables of 16 bits.  Two vectors are candidates
when they differ in at most one bit of some table, so with the four tables of
a 64-bit code every pair within Hamming distance 7 is found, and most beyond.
The index has one entry per vector and table; a probe asks for its own value
and for each value with one of its zero bits set.  A pair is thus met once in
each such table, and only the first of them reports it: no pair is shuffled
twice and no duplicates have to be removed.  Candidates are reranked with the
original vectors in double precision.

Equal vectors of one label are one node with a number of members, so that a
vector repeated many times is compared once.  Links between different vectors
are all counted, since the number of links is part of the result.

Defined results: rows with a null label or id, or a vector that is null, empty,
zero or holds a null or non-finite component, have no links and are their own
component (null for a null id).  Vectors of different length are never linked.
Equal repeated rows do not link with themselves; an id that repeats with
another value has the links of all its values.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import hash_sample, staged, table
from inkwell.llm.components import components

THRESHOLD = 0.98
BITS = 64
TABLE_BITS = 16
#: Vectors of one length that the rotation is fitted on, about.
SAMPLE = 4096
_ROUNDS = 40


def fit_rotation(x: np.ndarray, rounds: int = _ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(d x bits projection, thresholds) from sample vectors."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = x.shape[1]
    bits = min(BITS, d)
    centred = x - x.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    main = vectors[:, ::-1][:, :bits]
    v = centred @ main
    rotation = np.linalg.qr(np.random.default_rng(0).normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ rotation >= 0, 1.0, -1.0).T @ v)
        rotation = (left @ right).T
    projection = main @ rotation
    return projection, np.median(x @ projection, axis=0)


def rotations(vectors: DataFrame, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A rotation for each vector length in a sample of ``vectors`` (node,
    embedding)."""
    found: dict[int, list] = {}
    for r in hash_sample(vectors, "node", sample).select("embedding").collect():
        found.setdefault(len(r["embedding"]), []).append(r["embedding"])
    return {d: fit_rotation(np.array(rows, float)) for d, rows in sorted(found.items())}


def _unseen(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotation for a length that the sample does not have."""
    bits = min(BITS, d)
    return np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0][:, :bits], np.zeros(bits)


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _coder(known: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _lists(batch.column(1))
            codes = np.zeros(len(rows), np.uint64)
            for d in {len(r) for r in rows}:
                if d not in known:
                    known[d] = _unseen(d)
                projection, threshold = known[d]
                mine = np.array([i for i, r in enumerate(rows) if len(r) == d])
                x = np.array([rows[i] for i in mine], float)
                on = x @ projection >= threshold * np.linalg.norm(x, axis=1, keepdims=True)
                codes[mine] = (on.astype(np.uint64) << np.arange(on.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes.view(np.int64), pa.int64())], names=["node", "code"])
    return run


def coded(nodes: DataFrame, known: dict) -> DataFrame:
    """(node, code) for ``nodes`` (node, embedding)."""
    return nodes.select("node", "embedding").mapInArrow(_coder(known), "node long, code long")


def _table_value(code: Column, t: int) -> Column:
    return F.shiftrightunsigned(code, t * TABLE_BITS).bitwiseAND(F.lit((1 << TABLE_BITS) - 1).cast("long"))


def candidates(codes: DataFrame) -> DataFrame:
    """(a, b) of the codes (node, bucket, code) of one bucket that differ in
    at most one bit of some table; each pair once."""
    tables = range(-(-BITS // TABLE_BITS))
    entry = lambda t, value: F.struct(F.lit(t).alias("t"), value.alias("value"))
    index = codes.select("bucket", "node", "code", F.inline(F.array(
        *[entry(t, _table_value(F.col("code"), t)) for t in tables])))
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(TABLE_BITS)])

    def asked(t: int) -> Column:
        own = _table_value(F.col("code"), t)
        unset = F.filter(bits, lambda x: own.bitwiseAND(x) == 0)
        return F.transform(F.concat(F.array(F.lit(0).cast("long")), unset), lambda x: entry(t, own.bitwiseOR(x)))

    probes = codes.select("bucket", "node", "code", F.inline(F.concat(*[asked(t) for t in tables])))
    p, q = probes.alias("p"), index.alias("q")
    met = p.join(q, (F.col("p.bucket") == F.col("q.bucket")) & (F.col("p.t") == F.col("q.t"))
                 & (F.col("p.value") == F.col("q.value")) & (F.col("p.node") != F.col("q.node")))
    gap = F.col("p.code").bitwiseXOR(F.col("q.code"))
    # equal values meet from both sides; and an earlier table has reported the pair
    fresh = (_table_value(gap, 0) != 0) | (F.col("p.t") != 0) | (F.col("p.node") < F.col("q.node"))
    for t in tables:
        here = F.col("p.t") == t
        if t:
            fresh = fresh & (~here | (_table_value(gap, t) != 0) | (F.col("p.node") < F.col("q.node")))
        for earlier in range(t):
            fresh = fresh & (~here | (F.bit_count(_table_value(gap, earlier)) > 1))
    return met.where(fresh).select(
        F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b"))


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(_lists(batch.column(2)), _lists(batch.column(3)))):
                if len(x) == len(y):
                    x, y = x.astype(float), y.astype(float)
                    if x @ y >= threshold * np.sqrt((x @ x) * (y @ y)):
                        kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))
    return run


def linked(nodes: DataFrame, codes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b), a < b, between ``nodes`` (node, bucket, embedding)."""
    pairs = candidates(nodes.select("node", "bucket").join(codes, "node"))
    vectors = nodes.select("node", "embedding")
    both = pairs.join(vectors.toDF("a", "x"), "a").join(vectors.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return both.mapInArrow(_similar(threshold), "a long, b long")


def vector_nodes(vectors: DataFrame, id_col: str, vector_col: str, bucket_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, node or null), and the nodes (node, bucket, embedding,
    members) of the rows that can be linked."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(bucket_col).cast("string").alias("bucket"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("bucket").isNotNull() & finite
                        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = staged(rows.withColumn("usable", usable), "vectors")
    classes = rows.where("usable").groupBy("bucket", "embedding").agg(
        F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("members"))
    nodes = staged(classes.select("node", "bucket", "embedding", "members"), "nodes")
    return rows, nodes


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    bucket_col: str = "label", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``; only
    vectors of equal ``bucket_col`` are compared."""
    rows, nodes = vector_nodes(vectors, id_col, vector_col, bucket_col)
    codes = staged(coded(nodes, rotations(nodes, sample)), "codes")
    links = staged(linked(nodes, codes, threshold), "vector-links")
    members = nodes.select("node", "members")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    others = both.join(members.toDF("other", "m"), "other").groupBy("node").agg(F.sum("m").alias("near"))
    summary = nodes.select("node", "bucket", "embedding", "members").join(others, "node", "left") \
        .join(components(links), "node", "left").select(
            "bucket", "embedding", (F.col("members") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"))
    found = rows.where("usable").join(summary, ["bucket", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op10_itq_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
