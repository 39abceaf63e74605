"""Committed output: what other systems pick up.

A batch of rows is written to a staging folder together with a manifest (its
files with their sizes, and the number of rows), then published by renaming the
folder.  A reader sees a batch whole or not at all; a batch that is published
again under its name changes nothing; leftovers of a run that died stay in the
staging folder, which no reader looks at.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import scratch_path, store_of

MANIFEST = "manifest.json"


def _list(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    store, where = store_of(spark, path)
    return sorted((f.getPath().getName(), f.getLen()) for f in store.listStatus(where)) if store.exists(where) else []


def publish(df: DataFrame, root: str, name: str) -> bool:
    """Publish ``df`` as the batch ``name`` below ``root``; False if it was
    published before."""
    spark = df.sparkSession
    store, target = store_of(spark, f"{root}/{name}")
    if store.exists(target):
        return False
    staging = scratch_path(spark, "staging")
    df.write.parquet(staging)
    files = [f for f in _list(spark, staging) if f[0].endswith(".parquet")]
    rows = spark.read.schema(df.schema).parquet(staging).count()
    out = store.create(store_of(spark, f"{staging}/{MANIFEST}")[1], False)
    out.write(bytearray(json.dumps({"files": files, "rows": rows}).encode()))
    out.close()
    store.mkdirs(store_of(spark, root)[1])
    return store.rename(store_of(spark, staging)[1], target)


def manifest(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads(spark.read.text(f"{root}/{name}/{MANIFEST}", wholetext=True).first()[0])


def read_published(spark: SparkSession, root: str, schema) -> DataFrame:
    """The rows of all published batches below ``root``, with their ``batch``."""
    names = [n for n, _ in _list(spark, root)]
    paths = [f"{root}/{n}/{f}" for n in names for f, _ in manifest(spark, root, n)["files"]]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("string"))
    return spark.read.schema(schema).parquet(*paths).withColumn(
        "batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def published(df: DataFrame, what: str) -> DataFrame:
    """``df`` by way of a published batch below the shared scratch folder."""
    root = scratch_path(df.sparkSession, what)
    publish(df, root, "batch-0")
    return read_published(df.sparkSession, root, df.schema).drop("batch")
