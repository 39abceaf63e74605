"""K1 as a stream sink: a stored run table that micro-batches of changes are
merged into (SURVEY 2.2 K1, 2.9 T1).

The table is partitioned by a hash bucket of its key.  A batch of changes reads
and rewrites only the buckets that its articles fall into: the bucket list
prunes partitions on the way in, dynamic partition overwrite replaces them on
the way out.

A batch may be run again after a failure at any point.  Its merged buckets are
first written to a staging folder of their own; once that folder is complete it
is the batch's result for good, and the table's buckets are overwritten from it,
as often as it takes.  A run that dies before leaves the table untouched.  Ids
of new runs are part of the staged result, so a repeated batch gives out none.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.runs import latest_changes, run_upsert
from inkwell.session import scratch_path, store_of
from inkwell.sources.views import RUN_COLUMNS
from inkwell.streaming.jobs import read_feed

SCHEMA = ", ".join(f"{n} {t}" for n, t in RUN_COLUMNS) + ", bucket int"


def bucket_of(article_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(article_id), F.lit(buckets)).cast("int")


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the buckets of ``df`` in the table at ``path``, and no others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def create_run_table(runs: DataFrame, path: str, buckets: int = 64) -> None:
    df = runs.select(*[n for n, _ in RUN_COLUMNS], bucket_of(F.col("article_id"), buckets).alias("bucket"))
    df.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/table")
    runs.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("max_id")).coalesce(1).write.parquet(
        f"{path}/ids/batch_id=-1")


def read_run_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{path}/table")


def _max_id(spark: SparkSession, path: str, before: int) -> int:
    """The highest id given out before a batch."""
    ids = spark.read.schema("max_id bigint, batch_id bigint").parquet(f"{path}/ids")
    return ids.where(F.col("batch_id") < before).agg(F.max("max_id")).first()[0]


def merge_batch(spark: SparkSession, path: str, changes: DataFrame, batch_id: int, now: _dt.datetime,
                order: str = "seq", buckets: int = 64) -> list[int]:
    """Merge one batch of ``changes`` (article_id, ``order``, any run columns)
    into the table; the buckets it touched."""
    staged = f"{path}/staging/batch_id={batch_id}"
    store, done = store_of(spark, f"{staged}/_SUCCESS")
    if not store.exists(done):
        one = latest_changes(changes, order)
        key = bucket_of(F.col("article_id"), buckets)
        touched = sorted(r[0] for r in one.select(key).distinct().collect())  # at most one per bucket
        if not touched:
            return []
        current = read_run_table(spark, path).where(F.col("bucket").isin(touched)).drop("bucket")
        top = _max_id(spark, path, batch_id)
        merged = run_upsert(current, one, now, top).withColumn("bucket", key)
        # a bucket is as many files as it needs: large ones are split between tasks
        merged.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged)
    result = spark.read.schema(SCHEMA).parquet(staged)
    result.agg(F.greatest(F.max("id"), F.lit(_max_id(spark, path, batch_id))).alias("max_id")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/ids/batch_id={batch_id}")
    _overwrite(result, f"{path}/table")
    return sorted(r[0] for r in result.select("bucket").distinct().collect())


def stream_run_upsert(spark: SparkSession, runs: DataFrame, feed: str, schema, now: _dt.datetime,
                      buckets: int = 64, max_files: int | None = None) -> DataFrame:
    """Create a run table from ``runs``, merge the change feed into it batch by
    batch, and read it back."""
    path = scratch_path(spark, "run-table")
    create_run_table(runs, path, buckets)
    q = (read_feed(spark, feed, schema, max_files).writeStream
         .foreachBatch(lambda b, i: merge_batch(spark, path, b, i, now, buckets=buckets) and None)
         .option("checkpointLocation", scratch_path(spark, "ckpt-run-table")).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_run_table(spark, path).drop("bucket")
