"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.session import scratch_path

#: The ASCII white space that separates words, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.  This
    cuts the lineage: a lost executor costs a re-read, never a recomputation,
    and several consumers do not evaluate ``df`` again."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame of :func:`staged` that nothing reads any
    more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``most`` rows, else as
    it is (then the join shuffles).  For frames of a few numbers a row, written
    or cheap to count."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hash_sample(df: DataFrame, by: str, want: int) -> DataFrame:
    """About ``want`` rows of ``df`` (all, if it has fewer), chosen by a hash of
    ``by``; the same rows at every call, however the rows are dealt out."""
    share = want / max(want, df.count())
    return df.where(F.pmod(F.xxhash64(F.col(by), F.lit(7919)), F.lit(1 << 40)) < int(share * (1 << 40)))


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod))


def rows_of(batches: Iterator[pa.RecordBatch], max_chars: int = 4_000_000) -> Iterator[list[tuple]]:
    """Rows of Arrow batches as tuples, in blocks of bounded text volume; the
    last column is taken to be the text.  A text longer than ``max_chars``
    makes a block of its own.  Few rows of a batch are Python objects at once."""
    block, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 512).columns)):
                n = len(row[-1]) if row[-1] is not None else 0
                if block and size + n > max_chars:
                    yield block
                    block, size = [], 0
                block.append(row)
                size += n
    if block:
        yield block


def slices_of(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of bounded text volume; the last column is
    taken to be the text.  A text longer than ``max_bytes`` may be a slice of its
    own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + max_bytes, "right")))
            yield batch.slice(a, b - a)
            a = b


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of :func:`ascii_words` of texts in UTF-8 (binary), by Arrow's
    kernels: the distinct words, which of them each word is, and the number of
    words of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    size = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(parts.flatten())
    words, at = coded.dictionary.view(pa.binary()), coded.indices.to_numpy().astype(np.int64)
    kept = pc.binary_length(words).to_numpy() > 0  # white space at the ends of a text leaves empty parts
    if not kept.all():
        mine = kept[at]
        size = np.bincount(np.repeat(np.arange(len(size)), size)[mine], minlength=len(size))
        at = (np.cumsum(kept) - 1)[at[mine]]
        words = words.filter(pa.array(kept))
    return words, at, size


#: Bytes: A-Z lower-cased; other ASCII that is no letter or digit separates.
_TERM_BYTES = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


def ascii_terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of any other characters,
    ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, with A-Z lower-cased,
    as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def text_blocks(items: DataFrame, id_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The rows of ``items`` (id, text) that have both, as (id as string, text),
    in blocks of about ``block_bytes`` bytes of text (or one longer item); rows
    of one id are in one block.  One block at a time is in the driver."""
    sized = items.select(F.col(id_col).cast("string").alias("id"), "text").where("id is not null and text is not null")
    n = -(-(sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for k in range(n):
        yield [(r.id, r.text) for r in sized.where(F.pmod(F.xxhash64("id"), F.lit(n)) == k).collect()]


def ascii_words(text: str | bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text (or its UTF-8) with A-Z
    lower-cased, as UTF-8 (``bytes.split`` and ``bytes.lower`` touch exactly
    these ASCII bytes)."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
