"""Compare each ``queries()`` entry with its ``oracle_sql()`` text on DuckDB.

Mirrors the driver's gate: row count, column names (sorted), and an order-insensitive
hash of the values.  Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h


def duckdb_result(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def spark_result(df):
    return list(df.columns), [tuple(r) for r in df.collect()]


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as E
    qs, oracle = E.queries(), E.oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        s_cols, s_rows = spark_result(qs[name](spark, sf_dir))
        t1 = time.time()
        rec = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in oracle:
            d_cols, d_rows = duckdb_result(oracle[name], sf_dir)
            sc, sn, sh = digest(s_cols, s_rows)
            dc, dn, dh = digest(d_cols, d_rows)
            rec.update(oracle_rows=dn, schema=sc == dc, rows=sn == dn, values=sh == dh)
            rec["match"] = rec["schema"] and rec["rows"] and rec["values"]
            if not rec["schema"]:
                rec["cols"] = (sc, dc)
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from forumshift.session import local_test_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_test_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [n for n, r in res.items() if not r.get("match", True)]
    print("MISMATCH", bad if bad else "none")
