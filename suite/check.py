"""Compare every registered query with its SQL: python -m suite.check [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from . import all_cases
from .base import TABLES


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_cell(r[i])) for i in order) for r in rows)


def main() -> int:
    from terroir.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(
        "check", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    failed = []
    for name, case in all_cases().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = case.run(spark, sf_dir)
            got = _rows(df.columns, df.collect())
            took = time.time() - start
            if case.sql is None:
                print(f"rows  {name:28s} {len(got):7d} rows {took:6.2f}s", flush=True)
                continue
            cursor = con.execute(case.sql)
            columns = [d[0] for d in cursor.description]
            want = _rows(columns, cursor.fetchall())
            same_columns = sorted(columns) == sorted(df.columns)
            ok = same_columns and got == want
            print(f"{'ok   ' if ok else 'DIFF '} {name:28s} {len(got):7d} rows {took:6.2f}s", flush=True)
            if not ok:
                failed.append(name)
                print("   columns", sorted(df.columns), sorted(columns))
                print("   only spark", [r for r in got if r not in set(want)][:3])
                print("   only sql  ", [r for r in want if r not in set(got)][:3], len(want))
        except Exception as error:  # noqa: BLE001 - a report of all queries is wanted
            failed.append(name)
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
