"""Side-by-side check of a named Spark query against its DuckDB oracle text
(row count, column names/types, order-insensitive values). Used by the test
suite and runnable by hand:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from starloom.sources.tables import DRIVER_TABLES  # noqa: E402

# STARLOOM_EXACT=1 compares doubles bit for bit (the driver hashes values)
EXACT = os.environ.get("STARLOOM_EXACT", "") == "1"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, fn, text: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spark_schema = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    left = sdf.toPandas()
    t1 = time.time()
    rel = con.execute(text)
    duck_cols = [d[0] for d in rel.description]
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    right = pd.DataFrame(rel.fetchall(), columns=duck_cols)
    t2 = time.time()
    res = {"name": name, "spark_rows": len(left), "oracle_rows": len(right),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    if sorted(left.columns) != sorted(right.columns):
        res["ok"] = False
        res["why"] = f"columns differ: spark={sorted(left.columns)} oracle={sorted(right.columns)}"
        return res
    res["types"] = {c: (spark_schema[c], duck_types[c]) for c in sorted(left.columns)}
    if len(left) != len(right):
        res["ok"] = False
        res["why"] = "row count differs"
        return res
    lr, rr = _rows(left), _rows(right)
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    res["ok"] = not bad
    if bad:
        res["why"] = f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return res


TYPE_OK = {
    ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
    ("date", "DATE"), ("timestamp_ntz", "TIMESTAMP"), ("boolean", "BOOLEAN"),
}


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from starloom.session import get_session

    spark = get_session("local[8]", 8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    failures = 0
    for name in names or list(qs):
        if name not in oracle:
            print(f"-- {name}: no oracle (rows-only)")
            continue
        try:
            r = compare(spark, con, name, qs[name], oracle[name], sf_dir)
        except Exception as e:  # report and continue
            failures += 1
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}")
            continue
        types_bad = {c: t for c, t in r.get("types", {}).items() if t not in TYPE_OK}
        flag = "ok " if r["ok"] and not types_bad else "BAD"
        failures += flag == "BAD"
        print(f"{flag} {name}: rows={r['spark_rows']}/{r['oracle_rows']} {r['spark_sec']}s "
              f"{r.get('why', '')} {('types ' + str(types_bad)) if types_bad else ''}")
    print(f"failures: {failures}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
