"""Chat formatting over reply trees (native DataFrame functions).

Messages name the message that they answer.  Iterative self-joins enumerate the
root-to-leaf paths: each round joins every message's pointer with the pointer
of the message it points to, so that a path of depth n takes log2(n) rounds, and
only ids, lengths and score sums are shuffled; texts join once, at the end.  A
path's score is the sum of its messages' scores; the leaves of a tree are ranked
by it, and each chosen path becomes one conversation.  The pointers of each round
are kept as a table of jumps, by which the messages of the chosen paths, and only
those, are enumerated: no row holds a list of ancestors.

Template (a fixed value): ``<|im_start|>role<newline>text<|im_end|><newline>``
per turn.  In roles and texts the characters ``&``, ``<`` and ``[`` are written
``&amp;``, ``&lt;`` and ``&#91;``, and a line feed in a role ``&#10;``.  So no
control string of this or the common bracket templates can come from a text,
and :func:`parsed` restores every turn exactly.  The loss mask is the list of
the character ranges of assistant texts in the formatted string.

Defined results: null roles and texts are empty; a null tree id is a tree of its
own kind; a null message id cannot be answered.  A message whose parent is not
in its tree is a root; a message on a cycle has no path and appears in none.
Repeated message ids of one tree are one message, the smallest (role, text).
In :func:`linear_replies` equal turns are ordered by role and text and repeated
rows are turns of their own; a null turn comes first.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import staged, table
from inkwell.operators.sequence import number_within

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def _escaped(text: Column, role: bool = False) -> Column:
    for char, name in _ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(name))
    return F.replace(text, F.lit("\n"), F.lit("&#10;")) if role else text


def _unescaped(text: Column, role: bool = False) -> Column:
    if role:
        text = F.replace(text, F.lit("&#10;"), F.lit("\n"))
    for char, name in reversed(_ESCAPES):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _same(tree: str, message: str) -> Column:
    return F.col("tree").eqNullSafe(F.col("_t")) & F.col(tree).eqNullSafe(F.col(message))


def leaves(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The leaves (tree, leaf, path_score, length) that a root is above, with the
    number of messages on the path, and the jumps: the k-th frame tells (_t, _m,
    _up), the ancestor 2**k steps above each message that has one."""
    m = staged(messages.select("tree", "message", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")),
               "messages")
    ids = m.select(F.col("tree").alias("_t"), F.col("message").alias("_m"))
    known = m.join(ids, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_m")), "left") \
        .select("tree", "message", F.when(F.col("_m").isNotNull(), F.col("parent")).alias("up"), "score")
    # pointer doubling: score and length are of the messages from a message up to
    # the one below ``up``
    now = staged(known.withColumn("length", F.lit(1).cast("long")), "pointers")
    jumps, most = [], m.count()
    # what is still open after as many steps as there are messages runs in a cycle
    while (1 << len(jumps)) <= most:
        unfinished = now.where("up is not null")
        if not unfinished.limit(1).count():
            break
        jumps.append(unfinished.select(F.col("tree").alias("_t"), F.col("message").alias("_m"), F.col("up").alias("_up")))
        target = now.select(F.col("tree").alias("_t"), F.col("message").alias("_m"), F.col("up").alias("_up"),
                            F.col("score").alias("_score"), F.col("length").alias("_length"))
        step = unfinished.join(target, _same("up", "_m")).select(
            "tree", "message", F.col("_up").alias("up"), (F.col("score") + F.col("_score")).alias("score"),
            (F.col("length") + F.col("_length")).alias("length"))
        now = staged(now.where("up is null").union(step), "pointers")
    answered = known.where("up is not null").select(F.col("tree").alias("_t"), F.col("up").alias("_m")).distinct()
    ends = now.where("up is null").join(
        answered, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("message") == F.col("_m")), "left_anti")
    return ends.select("tree", F.col("message").alias("leaf"), F.col("score").alias("path_score"), "length"), jumps


def _enumerated(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(place, message) of every message on the paths of ``chosen`` leaves, beside
    their columns.  The largest jump first, each round adds the ancestors one jump
    above those found, so that every message of a path is met once; the rows are
    as many as the paths are long."""
    found = chosen.withColumn("message", F.col("leaf")).withColumn("place", F.col("length") - 1)
    for k in reversed(range(len(jumps))):
        higher = found.where(F.col("place") >= (1 << k)).join(jumps[k], _same("message", "_m"))
        higher = higher.withColumn("message", F.col("_up")).withColumn("place", F.col("place") - (1 << k))
        found = staged(found.union(higher.select(found.columns)), "paths")
    return found.drop("length")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, path_score, message, place) of every root-to-leaf path of
    ``messages`` (tree, message, parent, score).  place counts from 0 at the root."""
    ends, jumps = leaves(messages)
    return _enumerated(staged(ends, "leaves"), jumps)


def best_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """The paths of the ``top`` best leaves of each tree (all for None), by
    score and then by the smaller leaf id, with their rank.  Only the paths of
    chosen leaves are enumerated."""
    ends, jumps = leaves(messages)
    order = [F.desc("path_score"), F.asc("leaf")]
    if top is None:
        ranked = number_within(staged(ends, "leaves"), ["tree"], order, "rank")
    else:
        ranked = ends.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order))) \
            .where(F.col("rank") <= top)
    return _enumerated(staged(ranked, "leaves"), jumps)


def formatted(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, path_score, formatted, loss) for the chosen paths of
    ``messages`` (tree, message, parent, role, text, score); loss is an array
    of (start, end) character offsets, end exclusive."""
    whole = messages.groupBy("tree", "message").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                       F.col("parent"), F.col("score"))).alias("m"))
    whole = staged(whole.select("tree", "message", "m.*"), "turns")
    chosen = best_paths(whole, top)
    said = whole.select(F.col("tree").alias("_t"), F.col("message").alias("_m"), "role", "text")
    turns = chosen.join(said, F.col("tree").eqNullSafe(F.col("_t")) & F.col("message").eqNullSafe(F.col("_m"))).select(
        "tree", "leaf", "rank", "path_score", "place", (F.col("role") == "assistant").alias("own"),
        F.concat(F.lit(START), _escaped(F.col("role"), True), F.lit("\n")).alias("head"),
        _escaped(F.col("text")).alias("body"))
    lists = turns.groupBy("tree", "leaf", "rank", "path_score").agg(
        F.sort_array(F.collect_list(F.struct("place", "own", "head", "body"))).alias("turns"))
    tail = END + "\n"
    marks = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + len(tail)).alias("at"),
            F.when(t["own"], F.concat(s["loss"], F.array(F.struct(
                (s["at"] + F.length(t["head"])).alias("start"),
                (s["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))))).otherwise(s["loss"]).alias("loss")),
        lambda s: s["loss"])
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "")
    return lists.select("tree", "leaf", "rank", "path_score", text.alias("formatted"), marks.alias("loss"))


def parsed(formatted_text: Column) -> Column:
    """Array of (role, text) read back from a formatted string."""
    parts = F.filter(F.split(formatted_text, r"<\|im_start\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        cut = F.locate("\n", p)
        body = F.substr(p, cut + 1, F.length(p) - cut - len(END) - 1)
        return F.struct(_unescaped(F.substr(p, F.lit(1), cut - 1), True).alias("role"),
                        _unescaped(body).alias("text"))

    return F.transform(parts, lambda p: F.transform(F.array(p), turn)[0])


def masked(formatted_text: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: _unescaped(
        F.substr(formatted_text, s["start"] + 1, s["end"] - s["start"]))), "")


def linear_replies(turns: DataFrame) -> DataFrame:
    """Conversations of rows (conv_id, turn, role, text) as reply trees in which
    every turn answers the one before it."""
    numbered = number_within(turns.select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn", "role", "text"], "message")
    place = F.col("message").cast("long")
    return numbered.select(F.col("conv_id").alias("tree"), place.alias("message"), (place - 1).alias("parent"), "role", "text",
                           F.lit(0.0).alias("score"))


def op6_reply_trees(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    out = formatted(linear_replies(turns.union(extra)))
    read = out.select("tree", "formatted", parsed(F.col("formatted")).alias("turns"),
                      masked(F.col("formatted"), F.col("loss")).alias("learned"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The same digests straight from the table; the length of the formatted text
#: is that of its parts with their escapes.
ORACLE_OP6 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS t,
         replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS r
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(r) + length(t) + {len(START) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
