"""Run registered Spark queries and their DuckDB oracles side by side.

usage: python tools/oracle_check.py [--sf DIR] [name ...]

Compares row count, column names/types and an order-insensitive multiset of
rows (doubles rounded to 6 places).  Prints one line per query.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from lexis.plans.registry import oracles, queries  # noqa: E402
from lexis.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        return str(v.tolist())
    if isinstance(v, (list, tuple)):
        return str(list(v))
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))
    return cols, out


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", action="store_true")
    ap.add_argument("--plain", action="store_true", help="bare local[8] session with Spark defaults")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()

    if a.plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        import importlib.util
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(root, "__spark_entry__.py"))
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        print("entry rows:", entry.entry(spark).count())
        global queries, oracles
        queries, oracles = entry.queries, entry.oracle_sql
    else:
        from lexis.session import get_session
        spark = get_session("local[8]", 8, extra={"spark.driver.memory": "12g"})
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs, os_ = queries(), oracles()
    names = a.names or sorted(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = qs[n](spark, a.sf)
            spdf = sdf.toPandas()
            ts = time.time() - t0
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if n not in os_:
            print(f"{n:28s} rows={len(spdf):7d} (no oracle) spark={ts:.1f}s")
            continue
        t1 = time.time()
        try:
            dpdf = con.execute(os_[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        td = time.time() - t1
        sc, sr = _rows(spdf)
        dc, dr = _rows(dpdf)
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dtypes = dict(zip(dpdf.columns, [str(x) for x in dpdf.dtypes]))
        ok = sc == dc and len(sr) == len(dr) and sr == dr
        status = "OK " if ok else "MISMATCH"
        if not ok:
            bad += 1
        print(f"{n:28s} {status} rows spark={len(sr)} duck={len(dr)} spark={ts:.1f}s duck={td:.1f}s")
        if not ok:
            if sc != dc:
                print("   cols", sc, dc)
            else:
                diff = 0
                for x, y in zip(sr, dr):
                    if x != y:
                        diff += 1
                        if diff <= 2:
                            for i, c in enumerate(sc):
                                if x[i] != y[i]:
                                    print(f"   col {c}: spark={str(x[i])[:200]!r}\n          duck ={str(y[i])[:200]!r}")
                print(f"   differing rows (sorted zip): {diff}")
        if a.show:
            print("   types spark", stypes, "\n   types duck", dtypes)
    print(f"bad={bad} of {len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
