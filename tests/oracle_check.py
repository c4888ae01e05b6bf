"""Compare registered Spark queries with their DuckDB SQL twins.

Same checks as the driver's gate: row count, column names, and an
order-insensitive comparison of values with columns sorted by name.
Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import json
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _canon(rows):
    return sorted(json.dumps(r, sort_keys=True, default=str) for r in rows)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone = 'UTC'")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [[_norm(r[c]) for c in cols] for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        out["match"] = None
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [[_norm(r[i]) for i in order] for r in drows_raw]
    out["oracle_rows"] = len(drows)
    out["cols_match"] = cols == sorted(dcols)
    out["match"] = out["cols_match"] and _canon(srows) == _canon(drows)
    if not out["match"]:
        out["spark_cols"], out["oracle_cols"] = cols, sorted(dcols)
        a, b = set(_canon(srows)), set(_canon(drows))
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from martlane.session import get_spark

    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "error": repr(e)[:400]}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(json.dumps(r, ensure_ascii=False, default=str), flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
