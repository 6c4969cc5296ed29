"""Exact top-k search against all products."""

import math
import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001  # noqa: E402

from lexis.llm import cover_topk as ct  # noqa: E402
from lexis.llm.queries import oracles, queries  # noqa: E402


def brute(rows, every, k=5):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v]))
    dim = max([len(v) for _, v in good], default=0)
    good = [(i, v + [0] * (dim - len(v))) for i, v in good]
    seen, out = set(), []
    for i, v in sorted(good):
        if i % every == 0 and i not in seen:
            seen.add(i)
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def table(seed, n, dim, centres):
    rnd = np.random.default_rng(seed)
    c = rnd.normal(size=(centres, dim))
    return [(i, [float(np.float32(x)) for x in c[i % centres] + .2 * rnd.normal(size=dim)]) for i in range(n)]


def test_top_k(spark):
    rnd = random.Random(1)
    rows = table(1, 400, 8, 7) + table(2, 100, 8, 100)[:0]
    rows += [(1000 + i, list(rows[10][1])) for i in range(30)]                       # ties
    rows += [(2000, None), (2010, [None] * 8), (2020, [float("nan")] * 8), (2030, [float("inf")] * 8), (None, [9.0] * 8),
             (2040, []), (2050, [1.0]), (2060, [1e6] * 8), (10, rows[10][1]), (3001, rows[20][1]), (3001, rows[20][1])]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS leaf", "3 AS score")
    want = brute(rows, 10)
    for opt in ({}, {"block_rows": 16, "sample": 60}, {"sample": 1}):
        got = sorted(map(tuple, ct.top_k(df.repartition(5), lambda i: i % 10 == 0, **opt).collect()))
        assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in want]
        assert [g for g in got if g[0] != 10 and g[2] != 3001] == [w for w in want if w[0] != 10 and w[2] != 3001]
    assert ct.top_k(df.limit(0), lambda i: i % 10 == 0).count() == 0
    few = df.where("vec_id IN (20, 21, 30)")
    assert sorted(map(tuple, ct.top_k(few, lambda i: i % 10 == 0).collect())) == brute([r for r in rows if r[0] in (20, 21, 30)], 10)


def test_huge_components_and_scores(spark):
    """Components and scores beyond 64 bits are held at the ends of the range, ties to the smaller id."""
    top = 2 ** 63 - 1
    rows = [(i, [float(i), -1.0]) for i in range(1, 30)]
    rows += [(100, [1e17, 0.0]), (101, [1e300, 1e300]), (102, [-1e300, 3.0]), (110, [-1e17, -1e300]), (103, [1e8, 1e8]), (104, [1e8, 1e8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [max(-top - 1, min(top, math.floor(256 * x))) for x in v]) for i, v in rows]
    want = []
    for i, v in whole:
        if i % 10 == 0:
            s = sorted((-max(-top, min(top, sum(a * b for a, b in zip(v, w)))), j) for j, w in whole if j != i)[:5]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    for opt in ({}, {"block_rows": 4, "sample": 9}):
        assert sorted(map(tuple, ct.top_k(df.repartition(3), lambda i: i % 10 == 0, **opt).collect())) == sorted(want)


def test_walk_prunes_and_is_exact():
    rnd = np.random.default_rng(3)
    x = np.concatenate([rnd.normal(size=(200, 4)) * 5 + c for c in ([300, 0, 0, 0], [-300, 0, 0, 0], [0, 300, 0, 0], [0, 0, 300, 0])])
    tree = ct.fit_tree(x, 16)
    leaf = tree.descend(x)
    n = len(tree.centre)
    r, has, worst = np.zeros(n), np.zeros(n, bool), np.full(n, np.inf)
    kth = np.sort(x @ x.T, axis=1)[:, -3]
    for i, lf in enumerate(leaf):
        for node in tree.path(int(lf)):
            r[node] = max(r[node], np.linalg.norm(x[i] - tree.centre[node]))
            has[node] = True
            worst[node] = min(worst[node], kth[i])
    pairs = set(ct.walk(tree, r, r, worst, has, has))
    leaves = len(set(leaf.tolist()))
    assert len(pairs) < leaves * leaves / 2
    best = np.argsort(-(x @ x.T), axis=1)[:, :3]
    assert all((int(leaf[i]), int(leaf[j])) in pairs for i in range(len(x)) for j in best[i])


def test_products_are_exact():
    a = np.array([[2**31, 3], [1, -2]], dtype=np.int64)
    b = np.array([[2**31, 1]], dtype=np.int64)
    assert ct.products(a, b).tolist() == [[2**62 + 3], [2**31 - 2]]


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries()["op6_cover_topk"](spark, SF001).collect())) == brute(rows, 50)


def test_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    want = con.execute("SELECT query_id, rank, vec_id, score FROM (" + oracles()["op6_cover_topk"] + ") ORDER BY ALL").fetchall()
    assert sorted(map(tuple, queries()["op6_cover_topk"](spark, SF001).collect())) == want
