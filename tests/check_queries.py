"""Compare registered queries with their reference SQL: python tests/check_queries.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from workload.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return repr(v)


def rows_of(names, rows) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


# Spark type names as DuckDB names them
TYPES = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


def type_differences(got, want) -> list[str]:
    theirs = {c[0]: str(c[1]) for c in want.description}
    mine = {n: TYPES.get(t, t.upper()) for n, t in got.dtypes}
    return [f"{n}: {t} here, {theirs[n]} there" for n, t in mine.items() if theirs.get(n) != t]


def differences(spark, con, query, sql, sf_dir) -> str | None:
    got = query(spark, sf_dir)
    want = con.execute(sql)
    columns = [c[0] for c in want.description]
    if sorted(got.columns) != sorted(columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    types = type_differences(got, want)
    if types:
        return f"types {types}"
    mine = rows_of(got.columns, [tuple(r) for r in got.collect()])
    theirs = rows_of(columns, want.fetchall())
    if mine == theirs:
        return None
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    return f"{len(mine)} vs {len(theirs)} rows; only here {sorted(a)[:3]}; only there {sorted(b)[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from loadsieve.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, query, sqls[name], sf)
            else:
                found = None if query(spark, sf).count() else "no rows"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(f"{bad} failing")
