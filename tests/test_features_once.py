"""Models read their texts once."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from lexis.plans import q_models
from lexis.plans.registry import queries
from lexis.streaming import scorer


def test_axis_heads_share_one_pass_over_the_texts(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rows = [(f"{'alpha beta' if i % 2 else 'gamma delta'} w{i % 5}", i % 2, i % 3 == 0, i % 2, i % 5 < 2) for i in range(40)]
    docs = spark.createDataFrame([(t, *map(int, b)) for t, *b in rows], "text string, b_ie int, b_ns int, b_ft int, b_jp int")
    docs = docs.coalesce(1).mapInArrow(count, docs.schema)
    m = scorer.fit_axis_models(docs, num_features=1 << 8, max_iter=5)
    assert seen.value == 40
    p = m.transform(spark.createDataFrame([("alpha beta w1",), ("gamma delta w1",)], "text string")).select("_pred_ie", "_prob_jp").collect()
    assert [r["_pred_ie"] for r in p] == [1.0, 0.0] and len(p[0]["_prob_jp"]) == 2


def test_requests_without_chunks_keep_their_row(spark):
    class Model:
        def transform(self, rows):
            from pyspark.ml.functions import array_to_vector
            return rows.select("request_id", *[array_to_vector(F.array(F.lit(0.25), F.lit(0.75))).alias(f"_prob_{a}") for a in ("ie", "ns", "ft", "jp")])
    long = "one two three four five six seven eight nine ten eleven. "
    df = spark.createDataFrame([(1, long), (2, ""), (3, None), (2, "x")], "request_id long, text string")
    got = {r.request_id: (r.n_chunks, r.s_ns) for r in scorer.score_requests_with_model(df, Model()).collect()}
    assert got == {1: (1, 75.0), 2: (0, None), 3: (0, None)}


def test_fourier_rows_are_made_once(spark, monkeypatch):
    class Stop(Exception):
        pass

    def fit(est, train, test, col):
        for side in (train, test):
            assert "regexp" not in side._jdf.queryExecution().optimizedPlan().toString() and side.columns[:1] == ["doc_id"]
        assert train.count() > test.count() > 0
        raise Stop
    monkeypatch.setattr(q_models, "_fit_each_class", fit)
    with pytest.raises(Stop):
        queries()["model_rff_svm"](spark, SF001)
