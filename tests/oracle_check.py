"""Run registered queries next to their SQL: same column names, same rows."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value else "0.0"
    if isinstance(value, datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def normalized(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, run, sql: str) -> tuple[str, int]:
    df = run(spark, folder)
    got = normalized([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = normalized(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}", len(got)
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} rows differ, first {bad[0]}", len(got)
    return "", len(got)


if __name__ == "__main__":
    import __spark_entry__ as contract
    from sunledger.session import build_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(
        "check",
        "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem, n = compare(spark, con, folder, run, sqls[name])
            else:
                problem, n = "", len(run(spark, folder).collect())
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        spark.catalog.clearCache()
        failed += bool(problem)
        verdict, note = "FAIL" if problem else "ok  ", "" if name in sqls else "(no sql)"
        print(f"{verdict} {name} rows={n} {time.time() - start:.2f}s {note} {problem}", flush=True)
    print("failed:", failed)
