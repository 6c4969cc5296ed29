"""Compare Spark result column types with DuckDB oracle column types.

usage: python tools/type_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lexis.plans.registry import oracles, queries  # noqa: E402
from lexis.sources.tables import TABLES  # noqa: E402

SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from lexis.session import get_session
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs, os_ = queries(), oracles()
    bad = 0
    for n in a.names or sorted(os_):
        st = {f.name: f.dataType.simpleString() for f in qs[n](spark, a.sf).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {os_[n]}").fetchall()}
        diffs = [(c, st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt)) if SAME.get(st.get(c)) != dt.get(c)]
        if diffs:
            bad += 1
            print(f"{n:28s} {diffs}")
    print(f"type mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
