"""Skew-safe numbering of rows inside a group.

``row_number() over (partition by k order by o)`` sends every row of one key to
one task.  When a single key may hold a third of the table that task never
finishes.  ``number_within`` produces the same numbers without that hot task:

1. range-partition on ``(keys, order)``: a hot key is cut into many contiguous
   slices, one per partition, because the order columns split it;
2. number rows locally inside ``(partition id, keys)`` -- balanced, since the
   partition id is part of the key;
   The numbered slices are checkpointed so that steps 2 and 3 see the same
   cut;
3. count rows per ``(keys, partition id)`` and prefix-sum the counts of earlier
   partitions.  Only a key that continues from an earlier partition gets a
   non-zero offset, and a partition can start with at most one such key, so the
   offset table has at most ``#partitions`` rows: its broadcast is bounded by
   the partition count, not by the data.

For top-k (``row_number() <= k``) use a plain window instead: Spark inserts a
partial ``WindowGroupLimit`` before the shuffle, which already bounds hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import ensure_checkpoint_dir


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "pos",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based row number of each row inside its ``keys`` group,
    ordered by ``order`` (which must be a total order inside the group)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_cols = _cols(keys)
    order_cols = _cols(order)
    # repartitionByRange sorts ascending on the given expressions; descending
    # orders are passed as sort expressions and honoured.
    ranged = df.repartitionByRange(n, *key_cols, *order_cols).withColumn(
        "_pid", F.spark_partition_id()
    )
    local = ranged.withColumn(
        "_local",
        F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order_cols)),
    )
    # The range partitioner samples its bounds with a seed taken from the RDD
    # id, so two evaluations of ``ranged`` may cut the data differently.  Fix
    # the partition ids once: a reliable checkpoint in the shared checkpoint
    # folder (it also survives the loss of executors).
    ensure_checkpoint_dir(spark)
    local = local.checkpoint(eager=True)
    counts = local.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        counts.withColumn("_off", F.sum("_cnt").over(before))
        .where(F.col("_off") > 0)
        .select(*keys, "_pid", "_off")
    )
    off = offsets.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_pid").alias("_opid"), "_off",
    )
    cond = F.col("_pid") == F.col("_opid")
    for i, k in enumerate(keys):
        cond = cond & local[k].eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(off), on=cond, how="left")
    return joined.withColumn(
        name, (F.col("_local") + F.coalesce(F.col("_off"), F.lit(0))).cast("int")
    ).drop("_pid", "_local", "_off", "_opid", *[f"_k{i}" for i in range(len(keys))])
