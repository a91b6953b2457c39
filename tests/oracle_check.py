"""Run queries against their DuckDB oracles, like the driver's correctness gate.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from resale.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (pd.Timestamp,)):
        return str(v)
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def kind(dtype) -> str:
    s = str(dtype)
    if s.startswith("int") or s.startswith("Int") or s.startswith("uint"):
        return "int"
    if s.startswith("float"):
        return "float"
    if s.startswith("bool"):
        return "bool"
    if s.startswith("datetime"):
        return "datetime"
    return "object"


def compare(sdf: pd.DataFrame, odf: pd.DataFrame) -> str:
    if sorted(sdf.columns) != sorted(odf.columns):
        return f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return f"row count spark={len(sdf)} oracle={len(odf)}"
    kinds = {c: (kind(sdf[c].dtype), kind(odf[c].dtype)) for c in sdf.columns}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and not (len(sdf) and (sdf[c].isna().all() or odf[c].isna().all()))}
    if bad:
        return f"types differ: {bad}"
    a, b = rows_of(sdf), rows_of(odf)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"values differ, e.g. {diff}"
    return "ok"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = argv[1:]
    from __spark_entry__ import oracle_sql, queries
    from resale.session import get_session

    spark = get_session("local[8]", 8)
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    failures = 0
    for name in sorted(qs):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"rows {name}: {len(sdf)} rows (no oracle) {t1 - t0:.1f}s", flush=True)
            continue
        try:
            odf = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: oracle error {str(e)[:400]}", flush=True)
            continue
        res = compare(sdf, odf)
        if res != "ok":
            failures += 1
            print(f"FAIL {name}: {res}", flush=True)
        else:
            print(f"ok   {name}: {len(sdf)} rows {t1 - t0:.1f}s", flush=True)
    print(f"failures: {failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
