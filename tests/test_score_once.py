"""Expensive expressions run once for a row, however often later steps read them."""

from pyspark.sql import functions as F

from conftest import SF001
from lexis.operators import scoring as SC
from lexis.plans.registry import queries


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_class_probabilities_read_the_text_once(spark):
    df = spark.createDataFrame([(1, "Hello there!!!! ünd so"), (2, ""), (3, None)], "id long, text string")
    s = SC.score_axes(df, "text")
    x = s.select("id", SC.class_probs(s).alias("p"))
    assert plan(x).count("regexp_extract_all") == 1 and plan(x).count("EXP(") <= 4
    got = {r.id: r.p for r in x.collect()}
    assert abs(sum(got[1]) - 1) < 1e-9 and abs(sum(got[2]) - 1) < 1e-9 and got[3] == [None] * 16
    assert s.columns == ["id", "text", *[f"{c}_{a}" for a in ("ie", "ns", "ft", "jp") for c in ("logit", "p", "pred")]]
    assert plan(queries()["confusion_soft"](spark, SF001)).count("regexp_extract_all") == 1


def test_split_of_the_models_cleans_once(spark):
    r = queries()["model_split"](spark, SF001)
    assert "regexp_replace" not in plan(r) and r.where(F.col("split") == "test").count() > 0


def test_lemma_join_cleans_once(spark):
    r = queries()["txt_lemma_join"](spark, SF001)
    assert "\\.[^a-zA-Z]" not in plan(r) and "http" not in plan(r)
