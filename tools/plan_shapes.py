"""Print the physical plan tree (operator names only) of registered queries.

usage: python tools/plan_shapes.py [--sf DIR] name ...
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from lexis.plans.registry import queries
    from lexis.session import get_session
    spark = get_session("local[8]", 8, extra={"spark.driver.memory": "12g"})
    qs = queries()
    for n in a.names:
        df = qs[n](spark, a.sf)
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue().split("== Physical Plan ==")[-1]
        tree = [re.sub(r"\[.*$|\(.*$|#\d+", "", ln).rstrip() for ln in plan.splitlines()]
        tree = [t for t in tree if t.strip() and re.search(r"[A-Za-z]", t)]
        print(f"### {n}\n```")
        print("\n".join(tree[:60]))
        print("```\n")


if __name__ == "__main__":
    main()
