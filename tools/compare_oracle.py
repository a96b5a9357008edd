"""Compare every registered query with its DuckDB statement, value for value.

Usage: ``python tools/compare_oracle.py [sf] [query ...]`` (default sf 0.01).
Columns are compared by name, rows as sorted tuples, floats exactly.
Prints one line per query and a final count; exit status 1 on a mismatch.
"""

from __future__ import annotations

import importlib.util
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from tillroll.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def _rows(rows, columns):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "None"
        if isinstance(v, float):
            return repr(v)
        return str(v.item() if hasattr(v, "item") else v)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = set(sys.argv[2:])
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    entry = _entry()
    sql = entry.oracle_sql()
    failed = 0
    names = [n for n in entry.queries() if not only or n in only]
    for name in names:
        start = time.perf_counter()
        df = entry.queries()[name](spark, sf_dir)
        got = [tuple(r) for r in df.collect()]
        seconds = time.perf_counter() - start
        cur = con.execute(sql[name])
        expected = cur.fetchall()
        cols = [d[0] for d in cur.description]
        same = sorted(df.columns) == sorted(cols) and _rows(got, df.columns) == _rows(expected, cols)
        failed += not same
        print(f"{name:32s} {'OK ' if same else 'BAD'} rows={len(got):>8} duckdb={len(expected):>8} {seconds:6.1f}s")
    print(f"{len(names) - failed} of {len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
