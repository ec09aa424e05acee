"""Compare a registered Spark query with its DuckDB oracle SQL.

Used by the tests and by hand: ``python -m varpair.plans.oracle_check sf_dir [names...]``.
Columns are compared by name (sorted), rows as an order-insensitive multiset,
floats rounded to 6 decimals.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6) + 0.0))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else str(v))
    return (3, str(v))


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    body = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, body


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from .registry import ORACLE, QUERIES, load_all

    load_all()
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols, s_body = canon(sdf.columns, s_rows)
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["oracle"] = None
        return res
    rel = con.sql(ORACLE[name])
    d_cols_raw = rel.columns
    d_rows = rel.fetchall()
    d_cols, d_body = canon(d_cols_raw, d_rows)
    res.update(
        oracle_rows=len(d_rows),
        cols_match=s_cols == d_cols,
        rows_match=len(s_rows) == len(d_rows),
        values_match=s_body == d_body,
    )
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    if res["cols_match"] and not res["values_match"]:
        sset, dset = set(s_body), set(d_body)
        res["only_spark"] = [list(x) for x in list(sset - dset)[:3]]
        res["only_oracle"] = [list(x) for x in list(dset - sset)[:3]]
    return res


def main(argv):
    from ..session import local_session
    from .registry import QUERIES, load_all

    load_all()
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:800]}
        ok = r.get("values_match") and r.get("cols_match")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv[1:])
