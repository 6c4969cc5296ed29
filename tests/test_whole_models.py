"""The axis models at their full size, and the logistic regression, against the majority class."""

import pytest

from conftest import SF001, SF01
from lexis.plans import q_models
from lexis.plans.registry import queries


def test_linear_models_have_all_buckets_and_iterations(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    def fit(data, heads, n_features, loss, **options):
        seen.append((heads, n_features, loss, options["max_iter"]))
        raise Stop
    monkeypatch.setattr(q_models.LN, "fit", fit)
    for name in ("model_axes", "model_logreg", "model_linear_svc"):
        with pytest.raises(Stop):
            queries()[name](spark, SF001)
    assert seen == [(4, 1 << 18, "sigmoid", 100), (16, 1 << 18, "softmax", 100), (16, 1 << 18, "hinge", 10)]


def test_batch_scores_follow_the_texts(spark):
    """Axis IE says whether a document is English.  Persons' chunks (a person's label comes
    from another text) are judged by a model that saw none of them."""
    p = queries()["batch_score"](spark, SF01).toPandas()
    assert p[["person_id", "chunk_no"]].drop_duplicates().shape[0] == len(p)
    texts = queries()["pack_by_person"](spark, SF01).toPandas()
    both = p.merge(texts, on=["person_id", "chunk_no"])
    assert len(both) == len(texts) == len(p)
    long = both[both.chunk.str.len() > 200]
    english = long.chunk.str.contains(r"\b(?:the|and|of)\b").astype(int)
    assert 0.1 < english.mean() < 0.9 and (long.pred_ie == english).mean() > 0.9


def test_axis_models_on_a_larger_table(spark):
    r = {x["model"]: x for x in queries()["model_axes"](spark, SF01).collect()}
    assert set(r) == {"IE", "NS", "FT", "JP", "recombined"} and r["IE"]["accuracy"] > 0.9 and r["JP"]["accuracy"] > 0.8


def test_logistic_regression_beats_the_majority_class(spark):
    p = queries()["model_logreg"](spark, SF01).select("doc_id", "label", "prediction").toPandas()
    split = queries()["model_split"](spark, SF01).where("split = 'test'").toPandas()
    assert sorted(p["doc_id"]) == sorted(split["doc_id"])
    assert (p["label"] == p["prediction"]).mean() > p["label"].value_counts(normalize=True).max() + 0.1
