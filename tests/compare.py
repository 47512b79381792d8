"""Run queries on Spark and their SQL on DuckDB and compare whole results.

    python tests/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 1e9 else str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def family(kind) -> str:
    """Type families that both engines must agree on."""
    k = str(kind).lower().split("(")[0]
    for names, fam in (
        (("tinyint", "smallint", "int", "integer"), "int32"),
        (("bigint", "long"), "int64"), (("hugeint",), "int128"),
        (("double", "float"), "float"), (("decimal",), "decimal"), (("varchar", "string"), "string"),
        (("boolean",), "boolean"), (("date",), "date"),
    ):
        if k in names:
            return fam
    return "timestamp" if k.startswith("timestamp") else k


def compare(spark, con, name, sf):
    """(ok, message, seconds)."""
    from tidemark.queries import catalog

    t0 = time.time()
    df = catalog.QUERIES[name](spark, sf)
    rows = df.collect()
    took = time.time() - t0
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in rows)
    if name not in catalog.ORACLE:
        return True, f"rows only ({len(rows)})", took
    res = con.execute(catalog.ORACLE[name])
    names = [d[0] for d in res.description]
    kinds = {d[0]: family(d[1]) for d in res.description}
    if sorted(names) != cols:
        return False, f"columns {cols} vs {sorted(names)}", took
    idx = [names.index(c) for c in cols]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    odd = {
        c: (family(t), kinds[c]) for c, t in df.dtypes if family(t) != kinds[c] and "[]" not in kinds[c]
    }
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return False, f"{len(got)} vs {len(want)} rows; spark only {list(a)[:3]}; sql only {list(b)[:3]}", took
    return True, f"{len(rows)} rows" + (f" TYPES {odd}" if odd else ""), took


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    from tidemark.queries import catalog
    from tidemark.session import build_session

    spark = build_session(
        "compare", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name in args or list(catalog.QUERIES):
        try:
            ok, message, took = compare(spark, con, name, sf)
        except Exception as exc:  # noqa: BLE001
            ok, message, took = False, f"{type(exc).__name__}: {str(exc)[:700]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {took:6.2f}s {name}: {message}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
