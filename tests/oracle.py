"""Run registered queries next to their check SQL in DuckDB and compare whole results."""

from __future__ import annotations

import math
import sys
import time
import traceback
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _kind(v) -> str:
    return type(v).__name__


def _sorted(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    picked = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise the first difference."""
    df = fn(spark, sf_dir)
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    ints = {f.name for f in df.schema.fields if f.dataType.simpleString() == "int"}
    odd = [(d[0], str(d[1])) for d in cur.description if any(k in str(d[1]).upper() for k in ("HUGEINT", "DECIMAL", "TIMESTAMP", "NUMBER", "INT32", "INTEGER"))
           and str(d[1]).upper() not in ("BIGINT", "DOUBLE") and not (d[0] in ints and str(d[1]).upper() in ("INTEGER", "INT32"))]
    other = _sorted(names, cur.fetchall())
    if odd:
        return f"check SQL types {odd}"
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}; first {mine[:2]} vs {other[:2]}"
    bad = [(a, b) for a, b in zip(mine, other) if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, columns {sorted(names)}: {bad[0][0]} != {bad[0][1]}"
    return None


def main(argv: list[str]) -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from riskloom.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failures = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = compare(spark, con, fn, sqls[name], sf_dir)
            else:
                rows = fn(spark, sf_dir).collect()
                diff = None if rows else "no rows"
        except Exception as exc:  # report and go on
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
            if "-v" in argv:
                traceback.print_exc()
        failures += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {'' if name in sqls else '(rows only) '}{time.time() - t:.1f}s {diff or ''}", flush=True)
    print("failures", failures)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
