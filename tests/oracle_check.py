"""Compare every registered Spark query with its DuckDB statement.

Checks what the verification driver checks: row count, column names, and an
order-insensitive hash of the values. Usable from pytest and from the command
line: ``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0.0:
            return 0.0
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return digest(df.columns, rows)


def duck_digest(con, statement: str):
    cur = con.execute(statement)
    cols = [d[0] for d in cur.description]
    return digest(cols, cur.fetchall())


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry

    qs = entry.queries()
    oracles = entry.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            s = spark_digest(qs[name](spark, sf_dir))
        except Exception as exc:  # report and continue
            results[name] = ("SPARK-ERROR", repr(exc)[:400])
            if verbose:
                print(f"{name:45s} SPARK-ERROR {repr(exc)[:300]}", flush=True)
            continue
        t1 = time.time()
        if name not in oracles:
            results[name] = ("NO-ORACLE", s[0])
            if verbose:
                print(f"{name:45s} no oracle rows={s[0]} spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            d = duck_digest(con, oracles[name])
        except Exception as exc:
            results[name] = ("SQL-ERROR", repr(exc)[:400])
            if verbose:
                print(f"{name:45s} SQL-ERROR {repr(exc)[:300]}", flush=True)
            continue
        ok = s == d
        results[name] = ("OK" if ok else "MISMATCH", s[0], d[0], s[1] == d[1])
        if verbose:
            extra = "" if ok else f" spark_rows={s[0]} sql_rows={d[0]} cols_equal={s[1] == d[1]} {s[1] if s[1] != d[1] else ''} {d[1] if s[1] != d[1] else ''}"
            print(f"{name:45s} {'OK' if ok else 'MISMATCH'} rows={s[0]} spark={t1 - t0:.1f}s{extra}", flush=True)
    return results


if __name__ == "__main__":
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
