"""Run table: lookups, guards, history, upsert, staleness and the status
machine (SURVEY 2.1 S9; 2.2 K1; 2.3 F8, F9; 2.4 J3, J4; 2.7 R1; 2.9 T3
batch; 2.12 D1)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.reports import iso_timestamp
from inkwell.operators.sequence import number_within
from inkwell.session import scratch_path
from inkwell.sources.views import RUN_COLUMNS

# Run statuses.
STATUSES = ("pending", "processing", "awaiting_approval", "approved", "completed", "rejected", "failed")
HISTORY_LIMIT = 50
# The fields of a history row.
HISTORY_COLUMNS = (
    "id", "article_id", "blog_id", "title", "language", "status", "main_keyword",
    "target_keyword_input", "initial_surfer_score", "final_surfer_score", "score_delta",
    "score_delta_pct", "plagiarism_flagged", "plagiarism_max_similarity", "failure_reason",
    "asana_task_gid", "surfer_doc_id", "created_at", "completed_at", "duration_seconds",
)


def run_scan(spark, path: str) -> DataFrame:
    """Read a stored run table with its declared schema."""
    schema = ", ".join(f"{n} {t}" for n, t in RUN_COLUMNS)
    return spark.read.schema(schema).parquet(path)


def run_by_article(events: DataFrame, runs: DataFrame) -> DataFrame:
    """The run of each event's article; events without a run drop out.
    ``article_id`` is the run table's unique key, so at most one match."""
    return events.join(runs.select("article_id", F.col("id").alias("run_id"), "status"), "article_id", "inner")


def run_by_task(events: DataFrame, runs: DataFrame) -> DataFrame:
    """The run of each event's task (the lowest run id when several runs
    share a task); events without a run drop out."""
    per_task = runs.where(F.col("asana_task_gid").isNotNull()).groupBy(
        F.col("asana_task_gid").alias("task_gid")).agg(
        F.min(F.struct(F.col("id").alias("run_id"), "article_id", "status")).alias("_r"))
    return events.join(per_task, "task_gid", "inner").select(
        *events.columns, F.col("_r.run_id").alias("run_id"), F.col("_r.article_id").alias("article_id"),
        F.col("_r.status").alias("status"))


def approval_guard(decisions: DataFrame) -> DataFrame:
    """F8: approvals act only on runs awaiting approval (rejections have no
    guard)."""
    return decisions.where((F.col("decision") == "approve") & (F.col("status") == "awaiting_approval"))


def run_history_projection(runs: DataFrame) -> DataFrame:
    """the 20 history fields, timestamps as ISO text."""
    return runs.select(*[iso_timestamp(c).alias(c) if c in ("created_at", "completed_at") else F.col(c)
                         for c in HISTORY_COLUMNS])


def runs_last(runs: DataFrame, n: int = HISTORY_LIMIT) -> DataFrame:
    """Latest ``n`` runs by creation time (id breaks ties); a global
    top-k, planned as TakeOrderedAndProject (each task keeps only ``n``)."""
    return run_history_projection(runs.orderBy(F.desc("created_at"), F.desc("id")).limit(n))


def stale_pending_runs(runs: DataFrame, as_of: _dt.datetime, minutes: int = 60) -> DataFrame:
    """Runs still pending ``minutes`` after creation, as of ``as_of``."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return runs.where((F.col("status") == "pending") & (F.col("created_at") < cutoff)).select(
        "id", "article_id", "created_at")


def latest_changes(changes: DataFrame, order: str) -> DataFrame:
    """One row per article: of every column the last non-null value in the
    order of ``order`` (a partial aggregate)."""
    given = [c for c in changes.columns if c not in ("article_id", order)]
    if not given:
        return changes.select("article_id").distinct()
    return changes.groupBy("article_id").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in given])


def run_upsert(runs: DataFrame, changes: DataFrame, now: _dt.datetime, max_id: int | None = None) -> DataFrame:
    """K1: merge ``changes`` (``article_id`` + any run columns) into the run
    table.  Given, non-null columns overwrite; ``updated_at`` becomes ``now``
    on touched rows.  New articles are inserted as ``pending`` with fresh ids
    after the current maximum (numbered without a single-task window), which is
    ``max_id`` where ``runs`` is only a part of the table.

    The changes are evaluated once, into a table in the shared folder; only the
    article ids of the new ones are numbered."""
    spark = runs.sparkSession
    path = scratch_path(spark, "run-changes")
    changes.write.parquet(path)
    changes = spark.read.schema(changes.schema).parquet(path)
    given = [c for c in changes.columns if c != "article_id"]
    ch = changes.select("article_id", *[F.col(c).alias(f"_n_{c}") for c in given], F.lit(True).alias("_touch"))
    ts = F.lit(now).cast("timestamp_ntz")
    types = dict(RUN_COLUMNS)

    def merged(n: str, old: Column) -> Column:
        if n in ("id", "article_id"):
            return old
        if n == "updated_at":
            return F.when(F.col("_touch"), ts).otherwise(old)
        return F.coalesce(F.col(f"_n_{n}").cast(types[n]), old) if n in given else old

    updated = runs.join(ch, "article_id", "left").select(
        *[merged(n, F.col(n)).alias(n) for n, _ in RUN_COLUMNS])
    new_ids = ch.select("article_id").join(runs.select("article_id"), "article_id", "left_anti")
    top = runs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max")) if max_id is None else \
        spark.range(1).select(F.lit(max_id).alias("_max"))  # one row
    numbered = number_within(new_ids.withColumn("_g", F.lit(0)), ["_g"], ["article_id"], "_seq") \
        .crossJoin(F.broadcast(top)).select("article_id", (F.col("_max") + F.col("_seq")).alias("id"))
    first = {"created_at": ts, "status": F.lit("pending")}
    inserted = ch.join(numbered, "article_id").select(
        *[merged(n, F.col(n) if n in ("id", "article_id") else first.get(n, F.lit(None).cast(t))).alias(n)
          for n, t in RUN_COLUMNS])
    return updated.unionByName(inserted)


# --- T3: status machine as an associative fold -------------------------------
# A state is an index into STATES; each event is the function "state before ->
# state after", stored as an array over all states.  Composition of such
# functions is associative, so an ordered fold can be computed bucket by
# bucket: no row ever holds more than BUCKET events.

STATES = ("none",) + STATUSES
BUCKET = 512


def _idx(name: str) -> int:
    return STATES.index(name)


#: The moves of the status machine; other events change nothing.
MOVES = {
    "created": {"none": "pending"},
    "started": {"pending": "processing"},
    "scored": {"processing": "awaiting_approval"},
    "failed": {"pending": "failed", "processing": "failed"},
    "approve": {"awaiting_approval": "completed"},
    "reject": {s: "rejected" for s in STATUSES},
}


def transition_table(action: Column) -> Column:
    """``array<int>`` mapping every state to its successor under ``action``."""
    def nxt(state: str) -> Column:
        after = F.lit(_idx(state))
        for event, moves in MOVES.items():
            if state in moves:
                after = F.when(action == event, F.lit(_idx(moves[state]))).otherwise(after)
        return after

    return F.array(*[nxt(s) for s in STATES])


def _compose_sorted(fns: Column) -> Column:
    """Fold an ordered ``array<array<int>>`` of transition tables."""
    ident = F.array(*[F.lit(s) for s in range(len(STATES))])
    return F.aggregate(fns, ident, lambda acc, f: F.transform(acc, lambda s: F.element_at(f, s + 1)))


# Fixed value: how a rejected run records the reviewer's reason.
REJECTED_REASON = "Rejected: %s"


def fold_transitions(events: DataFrame, keys: list[str], levels: int = 3) -> DataFrame:
    """One transition table (``moves``) per ``keys``, of all its events in
    ``(ts, event_id)`` order, with the ``ts`` and ``event_id`` of the first and
    the last ``reject`` (ts, event_id, reason).  Events (with or without a
    ``reason``) are numbered per key without a single-task window, grouped
    ``BUCKET`` at a time, each bucket folded, then the buckets folded again,
    ``levels`` times and once more (512**4 events per key)."""
    if "reason" not in events.columns:
        events = events.withColumn("reason", F.lit(None).cast("string"))
    ev = number_within(events.select(*keys, "ts", "event_id", "action", "reason"), keys, ["ts", "event_id"], "_seq")
    return _folded(ev.select(
        *keys, (F.col("_seq") - 1).cast("long").alias("_pos"), "ts", "event_id",
        transition_table(F.col("action")).alias("moves"),
        F.when(F.col("action") == "reject", F.struct("ts", "event_id", "reason")).alias("reject")), keys, levels)


def _folded(cur: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """Compose numbered rows (keys, _pos, ts, event_id, moves, reject) bucket by
    bucket."""
    for level in range(levels + 1):
        bucket = (F.col("_pos") / BUCKET).cast("long") if level < levels else F.lit(0).cast("long")
        cur = cur.groupBy(*keys, bucket.alias("_b")).agg(
            F.min(F.struct("ts", "event_id")).alias("_first"), F.max("reject").alias("reject"),
            F.array_sort(F.collect_list(F.struct("_pos", "moves"))).alias("_l")
        ).select(*keys, F.col("_b").alias("_pos"), "_first.ts", "_first.event_id",
                 _compose_sorted(F.col("_l.moves")).alias("moves"), "reject")
    return cur


def _statuses(whole: DataFrame) -> DataFrame:
    """(article_id, status, failure_reason) from one table per article."""
    names = F.array(*[F.lit(s) for s in STATES])
    state = F.element_at(names, F.element_at("moves", _idx("none") + 1) + 1)
    return whole.select("article_id", state.alias("status"), "reject").where(F.col("status") != "none").select(
        "article_id", "status", F.when(F.col("status") == "rejected", F.format_string(
            REJECTED_REASON, F.coalesce("reject.reason", F.lit("")))).alias("failure_reason"))


def final_status(folded: DataFrame, levels: int = 1) -> DataFrame:
    """Final statuses from transition tables of disjoint stretches of an
    article's events (article_id, ts, event_id, moves, reject), composed by
    time."""
    numbered = number_within(folded, ["article_id"], ["ts", "event_id"], "_seq") \
        .withColumn("_pos", (F.col("_seq") - 1).cast("long"))
    return _statuses(_folded(numbered, ["article_id"], levels))


def run_state_machine(events: DataFrame) -> DataFrame:
    """T3 (batch): final status per article after its events in
    ``(ts, event_id)`` order, and the reason of a rejected one."""
    return _statuses(fold_transitions(events, ["article_id"]))
