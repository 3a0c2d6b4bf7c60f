"""Run registered queries against their DuckDB oracle SQL and compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return v


def digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def check(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(rows), "spark_s": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        out["match"] = None
        return out
    rel = con.sql(sql)
    orows = rel.fetchall()
    ocols = rel.columns
    out.update(oracle_rows=len(orows),
               cols_match=sorted(cols) == sorted(ocols),
               hash_match=digest(cols, rows) == digest(ocols, orows))
    out["match"] = out["cols_match"] and out["hash_match"] and len(rows) == len(orows)
    if not out["match"]:
        out["spark_cols"], out["oracle_cols"] = cols, ocols
        srt = sorted(json.dumps([norm(x) for x in r], default=str) for r in rows)
        ort = sorted(json.dumps([norm(x) for x in r], default=str) for r in orows)
        out["spark_only"] = [x for x in srt if x not in set(ort)][:3]
        out["oracle_only"] = [x for x in ort if x not in set(srt)][:3]
    return out


if __name__ == "__main__":
    from lodestone.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session(master="local[4]", shuffle_partitions=4)
    from __spark_entry__ import queries
    con = duck(sf)
    bad = 0
    for n in names or sorted(queries()):
        try:
            r = check(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("match") is False or "error" in r
        print(json.dumps(r, default=str), flush=True)
    print(f"mismatches/errors: {bad}")
