"""Run a query on a small table with odd rows, and its SQL on the same file."""

import duckdb
import pyarrow.parquet as pq

from compare import norm
from tidemark.llm import catalog


def both(spark, folder, name, table, rows, more=()):
    """(Spark's rows, SQL's rows), each sorted; ``rows`` is a pyarrow table; ``more`` names tables written before."""
    path = f"{folder}/{table}.parquet"
    pq.write_table(rows, path)
    df = catalog.QUERIES[name](spark, str(folder))
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in (table, *more):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    res = con.execute(catalog.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    return got, sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
