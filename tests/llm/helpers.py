"""Small inputs that the tests of this folder share."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"

#: Columns of documents, and some whose names the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, score string, "
          "node int, key string, id string, n int, kept string, word string, stratum int, comp int")

LONG = "wort für wort and word by word " * 20_000


def documents(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None, 7, "x", 1, "k", "i", 2, "?", "w", 3, 4) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows."""
    return documents(spark, [
        (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "Ein Text, one text!"), (5, "Ein Text, one text!"),
        (None, "text without an id"), (7, "text without a language", None), (8, "x" * 50_000), (9, "İΣ é <|endoftext|> 中国 🙂")])


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int, score string")


def duck(sf_dir=SMALL):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
