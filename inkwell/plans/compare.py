"""Local twin of the driver's correctness gate: run a Spark query and its
DuckDB oracle on the same parquet tables, compare row count, column names and
an order-insensitive hash of the values (columns sorted by name, doubles
rounded).  Used by ``scripts/check_oracles.py`` and the test-suite."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

from inkwell.sources.tables import SCHEMAS, table_path


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')"
        )
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return cols, lines


def digest(lines: list[str]) -> str:
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode("utf-8", "surrogatepass"))
        h.update(b"\n")
    return h.hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols, s_lines = canonical(list(spark_df.columns), s_rows)
    rel = con.sql(sql)
    d_cols, d_lines = canonical(list(rel.columns), rel.fetchall())
    out = {
        "rows_spark": len(s_lines),
        "rows_oracle": len(d_lines),
        "columns_match": s_cols == d_cols,
        "hash_match": s_cols == d_cols and digest(s_lines) == digest(d_lines),
    }
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    elif not out["hash_match"]:
        a, b = set(s_lines), set(d_lines)
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out
