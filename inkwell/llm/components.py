"""Connected components of a large edge list.

Alternating large-star / small-star rounds (Kiveris et al., *Connected
Components in MapReduce and Beyond*): every round is two aggregations and two
joins on node ids, the number of edges never grows, and the rounds are
logarithmic in practice.  No edge, label or component goes through the driver;
only a count and a checksum per round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import discard, staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over ``edges`` (a, b) with a > b."""
    if large:
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        moved = both.join(least, "u").where("v > u").select(F.col("v"), F.col("m"))
    else:
        # a's smaller neighbours and a itself all hang on the smallest of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        ).select("e.a", "e.m")
    moved = moved.toDF("a", "b").where("a <> b")
    return moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two columns of integer
    ids, either order; loops and nulls are ignored); component is the smallest
    id that can be reached.  An empty edge list gives an empty result."""
    x, y = edges.columns[:2]
    current = staged(
        edges.select(F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y")).where("x <> y")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = current.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
        ).first()
        if mark == seen:
            break
        seen = mark
        if not mark[0]:
            break
        following = staged(_stars(_stars(current, True), False), "edges")
        discard(current)
        current = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
