"""Compare each registered Spark query with its DuckDB oracle on one fixture folder.

Row count, column names and types, and an order-insensitive multiset of rows (columns
sorted by name; dates as ISO text; floats as repr; NULL/NaN as None) must
all agree. Run directly for a report:

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


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
        return repr(v + 0.0)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()[:10] if not isinstance(v, dt.datetime) or v.time() == dt.time() \
            else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v if isinstance(v, (str, bool, int)) else str(v)


def rows_of(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in tuples)


# Spark simple type name -> DuckDB type name (for the schema part of the check).
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(key)
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    if s_types != d_types:
        out["status"] = f"TYPES differ: spark={s_types} oracle={d_types}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(s_rows) != len(d_rows):
        out["status"] = "ROWCOUNT differs"
    elif a != b:
        diff_a = list((a - b).elements())[:3]
        diff_b = list((b - a).elements())[:3]
        out["status"] = f"VALUES differ: spark-only={diff_a} oracle-only={diff_b}"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries
    from ledgerspark.session import build_session
    keys = argv[2:] or list(queries())
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
