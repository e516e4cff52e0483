"""Compare a Spark query with its DuckDB twin: columns, rows and values.

Run directly: ``python tests/oracle.py [sf] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, fn, sql: str | None, sf_dir: str) -> tuple[str, int]:
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ("rows-only" if got[1] else "EMPTY"), len(got[1])
    rel = con.execute(sql)
    types = {d[0]: str(d[1]) for d in rel.description}
    want = _rows([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} != {want[0]}", len(got[1])
    if len(got[1]) != len(want[1]):
        return f"ROWS {len(got[1])} != {len(want[1])}", len(got[1])
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if bad:
        return f"VALUES {len(bad)} differ, first {bad[0]}", len(got[1])
    loose = {"int": {"INTEGER"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"},
             "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}}
    for name, spark_type in df.dtypes:
        if spark_type in loose and types[name] not in loose[spark_type]:
            return f"TYPE {name}: {spark_type} vs {types[name]}", len(got[1])
    return ("ok" if got[1] else "EMPTY"), len(got[1])


def main() -> int:
    import __spark_entry__ as entry
    from screenmeld.session import ROWS_PER_TASK_KEY, local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("oracle", 8)
    if "ROWS_PER_TASK" in os.environ:  # force the split path of ordered operators
        spark.conf.set(ROWS_PER_TASK_KEY, os.environ["ROWS_PER_TASK"])
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            verdict, n = compare(spark, con, queries[name], sql.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            verdict, n = f"ERROR {type(e).__name__}: {str(e)[:1500]}", 0
        fine = verdict in ("ok", "rows-only")
        failed += not fine
        print(f"{'+' if fine else '!'} {name}: {verdict} ({n} rows, {time.time() - start:.1f}s)",
              flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
