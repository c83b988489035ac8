"""Local stand-in for the correctness gate: runs queries() in Spark and
oracle_sql() in DuckDB on the same Parquet files and compares row count,
column names and an order-insensitive multiset of rounded values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


def type_diffs(spark_schema, duck_description):
    """Columns whose Spark type and DuckDB type differ."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
          for f in spark_schema.fields}
    dt = {d[0]: str(d[1]) for d in duck_description}
    return [(c, st[c], dt.get(c)) for c in st if st[c] != dt.get(c)]


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(norm(r[i]) for i in order) for r in records)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from strata.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        s_cols, s_set = rows_of(df.columns, s_rows)
        t1 = time.time()
        if name not in sqls:
            print(f"{name:40s} spark={len(s_rows):7d} rows  (no oracle)  {t1-t0:.1f}s")
            continue
        rel = con.execute(sqls[name])
        d_cols = [d[0] for d in rel.description]
        d_rows = rel.fetchall()
        d_cols, d_set = rows_of(d_cols, d_rows)
        tdiff = type_diffs(df.schema, rel.description)
        ok = s_cols == d_cols and len(s_rows) == len(d_rows) and s_set == d_set and not tdiff
        bad += not ok
        print(f"{name:40s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={'ok' if s_cols == d_cols else 'DIFF'} "
              f"types={'ok' if not tdiff else tdiff} values={'ok' if s_set == d_set else 'DIFF'} {t1-t0:.1f}s")
        if s_cols != d_cols:
            print("   spark:", s_cols, "\n   duck: ", d_cols)
        elif s_set != d_set:
            a, b = s_set - d_set, d_set - s_set
            print("   only spark:", list(a.items())[:3], "\n   only duck: ", list(b.items())[:3])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
