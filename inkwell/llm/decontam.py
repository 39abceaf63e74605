"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of ``window`` consecutive words of the benchmark items;
an item of fewer words is one pattern of its own length.  Wu and Manber's three
tables are built for the patterns of each length m, with words as symbols and
blocks of two words:

* SHIFT: for a block, the least distance from its places in the patterns to
  their end; a block in no pattern allows m - 1 words.  The search looks at the
  block that ends the current place and skips as far as the table allows; a last
  word that no pattern holds skips m words without looking any further.
* the buckets of the blocks that end a pattern (shift 0) select the patterns to
  test, by their first two words (Wu and Manber's prefix) ...
* ... and the words of the text are compared directly with those patterns.

The words of a text inside any occurrence are hit.

Scale: documents are read once, in one ``mapInArrow``; there is no shuffle.
Items are put together by id, and their patterns reach the tasks as broadcast
blocks of about ``block_bytes`` bytes of items (or one longer item).  A common
benchmark is one block.  More blocks are searched one after another over the
same piece of text, and only one is held in memory at a time.

Defined results: null and empty texts have no words; items without words or id
have no patterns; rows that share an item id are one item, which has the
patterns of each; repeated documents are searched one by one; without items
nothing is hit; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import ascii_terms, rows_of, table, text_blocks

WINDOW = 10

#: Bytes of item texts that are broadcast at a time (under 200 MB of tables in a
#: task), and characters of documents that are searched at a time.
BLOCK_BYTES = 1_200_000
PIECE_CHARS = 16_000_000


class Patterns:
    """Wu-Manber tables of the patterns of one length."""

    def __init__(self, length: int):
        self.length = length
        self.items: dict[tuple[bytes, ...], list[int]] = {}

    def add(self, words: tuple[bytes, ...], item: int) -> None:
        owners = self.items.setdefault(words, [])
        if not owners or owners[-1] != item:
            owners.append(item)

    def build(self) -> None:
        """SHIFT by pairs of words, and the buckets: (first two words, last two
        words) -> patterns.  Patterns of one word need neither."""
        m = self.length
        self.known = {w for p in self.items for w in p}
        self.shift: dict[tuple[bytes, bytes], int] = {}
        self.bucket: dict[tuple, list[tuple]] = {}
        for p in self.items:
            for end in range(1, m):
                block = p[end - 1:end + 1]
                self.shift[block] = min(m - 1 - end, self.shift.get(block, m))
            if m > 1:
                self.bucket.setdefault(p[:2] + p[-2:], []).append(p)

    def search(self, words: list[bytes]) -> list[tuple[int, tuple[bytes, ...]]]:
        """(first word, pattern) of every occurrence."""
        m, n, known, shift, bucket = self.length, len(words), self.known, self.shift.get, self.bucket.get
        found = []
        if m == 1:
            return [(i, (w,)) for i, w in enumerate(words) if w in known]
        far, i = m - 1, m - 1
        while i < n:
            last = words[i]
            if last not in known:
                i += m
                continue
            block = (words[i - 1], last)
            skip = shift(block, far)
            if skip:
                i += skip
                continue
            start = i - m + 1
            for p in bucket((words[start], words[start + 1], *block), ()):
                if tuple(words[start:i + 1]) == p:
                    found.append((start, p))
            i += 1
        return found


class Tables:
    """The patterns of a block of items, a table a length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids: list[str] = []
        self.by_length: dict[int, Patterns] = {}
        at: dict[str, int] = {}
        for item, text in items:
            words = ascii_terms(text)
            if not words:
                continue
            if item not in at:
                at[item] = len(self.ids)
                self.ids.append(item)
            m = min(window, len(words))
            patterns = self.by_length.setdefault(m, Patterns(m))
            for i in range(len(words) - m + 1):
                patterns.add(tuple(words[i:i + m]), at[item])
        for p in self.by_length.values():
            p.build()

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Places [start, end) of all occurrences, and the ids of their items."""
        places, items = [], set()
        for p in self.by_length.values():
            for start, pattern in p.search(words):
                places.append((start, start + p.length))
                items.update(p.items[pattern])
        return places, {self.ids[i] for i in items}


def covered(places: list[tuple[int, int]]) -> int:
    """Words inside any of the places."""
    total = end = 0
    for a, b in sorted(places):
        if b > end:
            total += b - max(a, end)
            end = b
    return total


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, the sorted ids (as
    strings) of the items of ``items`` (item_id, text) that occur, and the hit
    places as a list of [start, end) in words."""
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(Tables(b, window)) for b in text_blocks(items, "item_id", block_bytes)]
    schema = "doc_id long, n_words long, n_hit long, items array<string>, places array<struct<start:long,end:long>>"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("items", pa.list_(pa.string())),
                       ("places", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, PIECE_CHARS if len(blocks) > 1 else PIECE_CHARS // 4):
            texts = [ascii_terms(t) for _, t in rows]
            places, found = [[] for _ in rows], [set() for _ in rows]
            for block in blocks:
                tables = block.value
                for i, words in enumerate(texts):
                    p, x = tables.search(words)
                    if p:
                        places[i] += p
                        found[i] |= x
                if len(blocks) > 1:  # the task's copy goes; the next piece reads it again from the executor's disk
                    vars(block).pop("_value", None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": [r[0] for r in rows], "n_words": [len(w) for w in texts],
                "n_hit": [covered(p) for p in places], "items": [sorted(x) for x in found],
                "places": [[{"start": a, "end": b} for a, b in sorted(set(p))] for p in places]}, schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(search, schema)


def op12_wu_manber_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


#: Numbers the words, joins windows of every pattern length as strings.
ORACLE_OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS pattern
  FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS m,
               unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
x AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS pattern
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
hit AS (SELECT x.r, x.i, x.m, p.item_id FROM x JOIN p USING (m, pattern)),
n AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM hit) GROUP BY r),
j AS (
  SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit,
       coalesce(j.n_items, 0) AS n_items, sha256(coalesce(j.ids, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN j USING (r)"""
