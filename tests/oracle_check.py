"""Compare every registered query with its oracle SQL: ``python tests/oracle_check.py [sf_dir] [name…]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from riskframe.session import build_session  # noqa: E402


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:]
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = entry_module.oracle_sql()
    failed = []
    for name, query in entry_module.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = rows_of(df.columns, [tuple(row) for row in df.collect()])
            seconds = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {len(got[1])} rows {seconds:.1f}s", flush=True)
                continue
            cursor = connection.execute(oracles[name])
            want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
            if got == want:
                print(f"ok    {name} {len(got[1])} rows {seconds:.1f}s", flush=True)
                continue
            failed.append(name)
            print(f"DIFF  {name}: {len(got[1])} vs {len(want[1])} rows, columns {got[0]} vs {want[0]}", flush=True)
            shown = 0
            for a, b in zip(got[1], want[1]):
                if a != b and shown < 3:
                    print("   spark ", a, "\n   oracle", b, flush=True)
                    shown += 1
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"ERROR {name}: {type(error).__name__}: {str(error)[:600]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
