import math
import random

import numpy as np
import pytest

from lexis.operators import neighbors as N


def points(seed, n, dims, clusters):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 9) for _ in range(dims)] for _ in range(clusters)]
    return [(i, [c + rnd.gauss(0, 1) for c in centres[i % clusters]]) for i in range(n)]


def brute(train, test, k):
    return {(qi, r): ti for qi, qv in test for r, (_, ti) in enumerate(sorted((math.dist(qv, tv), ti) for ti, tv in train)[:k])}


@pytest.mark.parametrize("leaves,sample,bucket", [(1, 4096, 4096), (8, 30, 7), (40, 200, 1), (16, 4096, 50)])
def test_knn_exact_against_brute_force(spark, leaves, sample, bucket):
    pts = points(3, 300, 8, 5)
    train, test = pts[:250] + [(1000 + i, pts[0][1]) for i in range(60)], pts[250:] + [(400, pts[0][1])]    # copies: ties
    frames = [spark.createDataFrame(x, "id long, v array<double>").repartition(4) for x in (train, test)]
    got = N.knn(*frames, "id", "v", 3, leaves, sample, bucket).collect()
    assert {(r.query_id, r["rank"]): r.neighbor_id for r in got} == brute(train, test, 3)


def test_small_and_empty_tables(spark):
    schema = "id long, v array<float>"
    two = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [math.nan, 0.0]), (5, [None, 1.0])], schema)
    got = N.knn(two, spark.createDataFrame([(9, [0.0, 0.0]), (8, None)], schema), "id", "v", 5).collect()
    assert sorted((r.query_id, r["rank"], r.neighbor_id, r.dist) for r in got) == [(9, 0, 1, 0.0), (9, 1, 2, 5.0)]
    assert N.knn(two.limit(0), two, "id", "v", 2).count() == 0
    assert N.knn(two, two.limit(0), "id", "v", 2).count() == 0


def test_tree_holds_its_points_and_prunes(spark):
    x = np.array([v for _, v in points(5, 2000, 6, 12)])
    tree = N.BallTree.fit(x, 24)
    assert tree.n_leaves == 24
    seen = np.zeros(len(x), int)
    for node, rows, d in tree.visit(x):
        assert np.allclose(d, np.sqrt(((x[rows] - tree.centre[node]) ** 2).sum(1)))
        seen[rows] += tree.leaf[node] >= 0
    assert (seen == 1).all()
    assert N.BallTree.fit(np.ones((50, 3)), 8).n_leaves == 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "id long, v array<double>")
    r = N.routed_share(df, df.where("id % 20 = 0"), "id", "v", 2, n_leaves=24).first()
    assert r.queries == 100 and r.evaluated_share < 0.25            # twelve clusters: a query meets few of them


def test_knn_vote_ties_to_smaller_label(spark):
    neigh = spark.createDataFrame([(1, 0, 10, 0.1), (1, 1, 11, 0.2)], "query_id long, rank int, neighbor_id long, dist double")
    labels = spark.createDataFrame([(10, 7), (11, 3)], "id long, label int")
    assert N.knn_predict(neigh, labels, "id", "label").first()["pred"] == 3
