"""Structured Streaming forms of the event flows.

The same DataFrame operators as the batch queries run on a file stream, in
micro-batches of bounded size.  Every micro-batch writes a folder of its own and
overwrites it, so a batch that is run again changes nothing, and no batch reads
what earlier ones wrote: what spans batches (the first delivery of an article) is
settled by an exact aggregation over the sink.  Sinks and checkpoints live under
the shared ``spark.checkpoint.dir``.  Flows with keyed state and timers are in
``inkwell.streaming.state``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import events as E
from inkwell.session import scratch_path, store_of

#: Bytes of input of one micro-batch.
MAX_BYTES = 64 << 30
#: Bytes of a file of a staged feed, about: what one task reads.
FILE_BYTES = 8 << 20


def stage(df: DataFrame, name: str) -> str:
    """Write a feed as parquet files in the shared folder, partitioned as the
    frame is."""
    path = scratch_path(df.sparkSession, f"feed-{name}")
    df.write.parquet(path)
    return path


def read_feed(spark: SparkSession, path: str, schema, max_files: int | None = None,
              max_bytes: int = MAX_BYTES) -> DataFrame:
    """A file stream in micro-batches of ``max_bytes``, or of ``max_files``."""
    reader = spark.readStream.schema(schema)
    limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", max_bytes)
    return reader.option(*limit).parquet(path)


def stage_slices(df: DataFrame, slice_no: Column, name: str, slices: int, file_bytes: int = FILE_BYTES) -> str:
    """Write a feed as ``slices`` arrivals (rows by ``slice_no``, from 0), one
    after another.  A file stream reads files in the order they were written, and
    every slice has the same number of files (:func:`files_a_slice`), so that a
    micro-batch of so many files is a slice.  The rows are worked out once, and
    no task writes or reads more than a file of about ``file_bytes``."""
    spark = df.sparkSession
    path, whole = scratch_path(spark, f"feed-{name}"), scratch_path(spark, f"slices-{name}")
    df.withColumn("_slice", slice_no).write.partitionBy("_slice").parquet(whole)
    rows = spark.read.schema(f"{df.schema.toDDL()}, _slice int").parquet(whole)
    files = max(1, *(-(-_bytes(spark, f"{whole}/_slice={i}") // file_bytes) for i in range(slices)))
    for i in range(slices):
        mine = rows.where(F.col("_slice") == i).select(df.columns)
        (mine.coalesce(1) if files == 1 else mine.repartition(files)).write.mode("append").parquet(path)
        while len(_files(spark, path)) < (i + 1) * files:  # a part without rows has no file
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return path


def _files(spark: SparkSession, path: str) -> list:
    store, where = store_of(spark, path)
    return [f for f in (store.listStatus(where) if store.exists(where) else []) if f.getPath().getName().endswith(".parquet")]


def _bytes(spark: SparkSession, path: str) -> int:
    return sum(f.getLen() for f in _files(spark, path))


def files_a_slice(spark: SparkSession, path: str, slices: int) -> int:
    """Files of each slice of a feed of :func:`stage_slices`."""
    return max(1, len(_files(spark, path)) // slices)


#: Slices of a feed that arrives by time.
ARRIVALS = 6


def stage_arrivals(df: DataFrame, arrival: str, name: str, slices: int = ARRIVALS) -> str:
    """Write a feed as it would have arrived: ``slices`` equal stretches of the
    timestamp ``arrival``, as :func:`stage_slices` has them."""
    at = F.unix_micros(F.col(arrival).cast("timestamp"))
    low, high = df.agg(F.min(at), F.max(at)).first()
    if low is None:
        return stage(df, name)
    return stage_slices(df, F.least(((at - low) * slices / (high - low + 1)).cast("int"), F.lit(slices - 1)), name, slices)


def run_stream(stream: DataFrame, name: str, batch_fn, output_mode: str = "append") -> str:
    """Run a stream to its end; each batch overwrites its own sink folder.  The
    rows carry their batch as ``_batch``."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"sink-{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_fn(batch).withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write).outputMode(output_mode)
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def read_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches of a sink; an empty frame if no batch was run.  Any other
    failure to read is an error."""
    store, where = store_of(spark, path)
    if not store.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def stream_draft_intake(spark: SparkSession, webhooks: DataFrame, runs: DataFrame, secret: str,
                        blog_id: str | None = None, max_files: int | None = None) -> DataFrame:
    """F3 -> S2 -> F1 -> F2 -> first delivery per article, never an article
    that already has a run.  A batch keeps its first delivery of each article;
    the sink's readers keep the first of all batches, in whatever order the
    files came, so a late delivery is never lost to a watermark."""
    path = stage(webhooks, "webhooks")
    stream = read_feed(spark, path, webhooks.schema, max_files)
    drafts = E.blog_filter(E.draft_filter(E.webhook_parse(E.signature_filter_base64(stream, secret))), blog_id)
    known = runs.select("article_id")

    def batch(b: DataFrame) -> DataFrame:
        return E.first_per_article(b).join(known, "article_id", "left_anti").select("delivery_id", "article_id")

    out = run_stream(drafts.select("delivery_id", "article_id"), "intake", batch)
    return read_sink(spark, out, "delivery_id bigint, article_id string").groupBy("article_id").agg(
        F.min("delivery_id").alias("delivery_id")).select("delivery_id", "article_id")


def stream_intake_within(spark: SparkSession, path: str, schema, runs: DataFrame, secret: str, within: str,
                         blog_id: str | None = None, max_files: int | None = None) -> DataFrame:
    """T1 with bounded state: deliveries at ``path`` (event time
    ``delivered_at``) pass once per article ``within`` the watermark, never for
    an article that already has a run.  What repeats later than ``within`` after
    the first passes again, and what arrives later than ``within`` is dropped:
    the price of a state that forgets.  ``stream_draft_intake`` is the exact
    form.  Returns the accepted deliveries."""
    stream = read_feed(spark, path, schema, max_files).withColumn("delivered_at", F.col("delivered_at").cast("timestamp")) \
        .withWatermark("delivered_at", within)
    parsed = E.webhook_parse(E.signature_filter_base64(stream, secret), keep=("delivered_at",))
    once = E.blog_filter(E.draft_filter(parsed), blog_id).dropDuplicatesWithinWatermark(["article_id"])
    known = runs.select("article_id")
    out = run_stream(once.select("delivery_id", "article_id"), "intake-within",
                     lambda b: b.join(known, "article_id", "left_anti").select("delivery_id", "article_id"))
    return read_sink(spark, out, "delivery_id bigint, article_id string")


def stream_comment_routing(spark: SparkSession, deliveries: DataFrame, stories: DataFrame, secret: str,
                           max_files: int | None = None) -> DataFrame:
    """F4 -> S3 -> F5 -> J5 (stream-static join) -> X18."""
    path = stage(deliveries, "comments")
    stream = read_feed(spark, path, deliveries.schema, max_files)
    ev = E.comment_event_filter(E.comment_event_explode(E.signature_filter_hex(stream, secret)))
    routed = E.route_comment(E.story_text_join(ev, stories)).select(
        "delivery_id", "event_no", "story_gid", "task_gid", "comment_text", "decision", "reason")
    return read_sink(spark, run_stream(routed, "comments", lambda b: b), routed.schema)
