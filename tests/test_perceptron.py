"""The perceptron on packed bits against Spark ML's own trainer."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from conftest import SF001
from lexis.operators import models as MD
from lexis.operators import perceptron as PC
from lexis.plans import q_models
from lexis.plans.registry import queries

SCHEMA = Ty.StructType([Ty.StructField("label", Ty.DoubleType()), Ty.StructField("features", VectorUDT())])


def table(spark, n=400, n_in=20, classes=3, seed=4):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rnd.integers(classes))
        x = rnd.random(n_in) < np.where(np.arange(n_in) % classes == y, 0.6, 0.2 + 0.6 * (i % 7 == 0))
        at = np.flatnonzero(x)
        rows.append((i, float(y), Vectors.dense(x.astype(float)) if len(at) > 12 else Vectors.sparse(n_in, at.tolist(), [1.0] * len(at))))
    return spark.createDataFrame(rows, ["doc_id", "label", "features"])


@pytest.mark.parametrize("partitions,iterations", [(1, 5), (3, 15)])
def test_weights_equal_spark_mls(spark, partitions, iterations):
    df = table(spark).coalesce(1).repartition(partitions).persist()
    est = MD.mlp(20, 3, 4, iterations)
    want, got = est.fit(df), PC.fit(est, df)
    assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-3, atol=1e-3)
    probs = [np.array([r[0].toArray() for r in m.transform(df).orderBy("doc_id").select("probability").collect()]) for m in (got, want)]
    assert np.allclose(*probs, atol=1e-4)
    df.unpersist()


def test_gradient_is_the_slope(spark):
    rnd = np.random.default_rng(1)
    sizes = (10, 4, 3)
    w = rnd.normal(size=10 * 4 + 4 + 4 * 3 + 3)
    x, y, share = (rnd.random((30, 10)) < 0.4).astype(float), rnd.integers(0, 3, 30), np.full(30, 0.1)
    g = np.zeros(len(w))
    PC.add_gradient(g, w, sizes, x, y, share)
    for i in range(0, len(w), 5):
        step = np.zeros(len(w))
        step[i] = 1e-5
        up, down = (PC.add_gradient(np.zeros(len(w)), w + s, sizes, x, y, share) for s in (step, -step))
        assert abs((up - down) / 2e-5 - g[i]) < 1e-6


def test_rows_are_kept_as_bits(spark):
    df = table(spark, 300).coalesce(1)
    bits = PC.packed(df, 20, 3, 128).collect()
    assert all(len(r["bits"]) == 3 for r in bits) and abs(sum(r["share"] for r in bits) - 3) < 1e-12
    back = np.unpackbits(np.array([list(r["bits"]) for r in bits], np.uint8), axis=1, count=20)
    assert (back == np.array([r["features"].toArray() for r in df.collect()])).all()


@pytest.mark.parametrize("bad", [(None, [0.0, 1.0]), (5.0, [0.0, 1.0]), (0.5, [0.0, 1.0]), (1.0, [0.0, 2.0])])
def test_bad_rows_fail(spark, bad):
    df = spark.createDataFrame([(0.0, Vectors.dense([1.0, 0.0])), (bad[0], Vectors.dense(bad[1]))], SCHEMA)
    with pytest.raises(Exception, match="labels must be|without label|other than"):
        PC.packed(df, 2, 2, 128).collect()


def test_queries_train_on_packed_bits(spark, monkeypatch):
    """The perceptron queries do not stack dense rows: their trainer is the one on bits."""
    seen = []

    class Stop(Exception):
        pass

    def fit(est, rows):
        seen.append((list(est.getLayers()), est.getMaxIter()))
        assert rows.where(F.col("split") == "test").count() == 0
        raise Stop
    monkeypatch.setattr(q_models.PC, "fit", fit)
    for name in ("model_mlp_axis", "model_mlp_16"):
        with pytest.raises(Stop):
            queries()[name](spark, SF001)
    assert seen == [([6144, 16, 2], 50), ([6144, 16, 16], 50)]
