"""Run registered queries against their SQL twins and report differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

#: The generated tables that tests run on.
SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when rows, names and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(actual) != len(expected):
        out.append(f"rows {len(actual)} != {len(expected)}")
    ordered = sorted(names)
    for a, e in zip(actual, expected):
        if a != e:
            cells = [f"{ordered[i]}: {x!r} != {y!r}" for i, (x, y) in enumerate(zip(a, e)) if x != y]
            out.append("; ".join(cells[:6]))
            if len(out) > 4:
                break
    return out


def main(folder: str, *wanted: str) -> int:
    import __spark_entry__ as entry
    from tradewind.session import build_session

    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problems = differences(query(spark, folder), con, sql[name]) if name in sql else [f"no SQL; {query(spark, folder).count()} rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
