"""Run queries beside their SQL, as sorted rows: python tests/compare.py [sf] [name ...]."""

import hashlib
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry
from lacquer.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings chapters glossary chat_results chunk_lines relation_edges chunk_caps eval_items".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def digest(rows: list[tuple], columns: list[str]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join("\x00" if r[i] is None else str(r[i]) for i in order) for r in rows)
    return len(rows), sorted(columns), hashlib.md5("\x1e".join(lines).encode()).hexdigest()


def check(name: str, spark, con, sf_dir: str) -> tuple[bool, str]:
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - began
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows only, {took:.1f} s"
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want_rows = cur.fetchall()
    got, want = digest(rows, df.columns), digest(want_rows, columns)
    if got == want:
        return True, f"{got[0]} rows, {took:.1f} s"
    a = {str(sorted(zip(df.columns, map(str, r), strict=True))) for r in rows}
    b = {str(sorted(zip(columns, map(str, r), strict=True))) for r in want_rows}
    return False, f"{got[:2]} against {want[:2]}\n  here only: {list(a - b)[:2]}\n  there only: {list(b - a)[:2]}"


if __name__ == "__main__":
    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark, con = local_session(), connect(sf)
    for q in sys.argv[2:] or [n for n in entry.queries() if not re.match(r"p\d", n)]:
        try:
            good, said = check(q, spark, con, sf)
        except Exception as e:  # noqa: BLE001
            good, said = False, f"{type(e).__name__}: {str(e)[:700]}"
        print("ok  " if good else "FAIL", q, said, flush=True)
