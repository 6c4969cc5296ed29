"""Fitted models against the majority class, and the split they share."""

import pytest

from conftest import SF001, SF01
from lexis.plans.registry import queries


@pytest.mark.parametrize("name,margin", [("model_rf", 0.1), ("model_rff_svm", 0.02), ("model_linear_svc", 0.02)])
def test_model_beats_the_majority_class(spark, name, margin):
    p = queries()[name](spark, SF01).select("doc_id", "label", "prediction").toPandas()
    split = queries()["model_split"](spark, SF01).where("split = 'test'").toPandas()
    assert sorted(p["doc_id"]) == sorted(split["doc_id"])
    assert (p["label"] == p["prediction"]).mean() > p["label"].value_counts(normalize=True).max() + margin


def test_axis_models_and_their_matrix(spark):
    r = {x["model"]: x for x in queries()["model_axes"](spark, SF001).collect()}
    assert set(r) == {"IE", "NS", "FT", "JP", "recombined"} and r["IE"]["accuracy"] > 0.8
    m = queries()["model_axes_matrix"](spark, SF001).toPandas()
    assert len(m) == 256
    right = m[m["row"] == m["col"]]["n"].sum() / m["n"].sum()
    assert abs(right - r["recombined"]["accuracy"]) < 1e-9


def test_hashed_counts_lose_no_token(spark):
    from lexis.operators import models as MD
    df = spark.createDataFrame([(1, "aa bb aa cc the"), (2, ""), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: r["features"] for r in MD.count_features(df, "text").collect()}
    assert got[1].toArray().sum() == 4 and got[2].numNonzeros() == 0 and got[3].numNonzeros() == 0
