"""Metric operators against the published confusion counts, and log parsing
against literal log lines."""

import pytest
from pyspark.sql import functions as F

from lexis.operators import metrics as M
from lexis.sources import logs as LG


@pytest.mark.parametrize("tp,fp,fn,tn,acc,f1", [
    (106, 15, 80, 667, 0.890553, 0.690554),
    (75, 5, 42, 746, 0.945853, 0.761421),
    (377, 47, 28, 416, 0.913594, 0.909530),
    (459, 86, 46, 277, 0.847926, 0.874286),
])
def test_f1_from_counts(spark, tp, fp, fn, tn, acc, f1):
    rows = [(1, 1)] * tp + [(1, 0)] * fp + [(0, 1)] * fn + [(0, 0)] * tn
    df = spark.createDataFrame(rows, "pred int, target int")
    c = M.binary_counts(df, "pred", "target").select("tp", "fp", "fn", "tn", *M.f1_columns()).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (tp, fp, fn, tn)
    assert round(c["accuracy"], 6) == acc
    assert round(c["f1"], 6) == f1 and round(c["f1_binary"], 6) == f1


def test_confusion_grid_dense(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 3)], "p int, a int")
    g = M.confusion_long(df, "p", "a", 4)
    assert g.count() == 16 and g.agg(F.sum("n")).first()[0] == 3
    assert g.where("row = 1 AND col = 2").first()["n"] == 2


def test_confusion_loses_no_row(spark):
    rows = [(1, 2), (None, 2), (3, None), (7, 0), (0, -5), (None, None)]
    df = spark.createDataFrame(rows, "p int, a int")
    for side in ("pred", "actual"):
        g = M.confusion_long(df, "p", "a", 4, rows=side)
        assert g.agg(F.sum("n")).first()[0] == len(rows)
        assert g.where(f"row = {M.OTHER} OR col = {M.OTHER}").agg(F.sum("n")).first()[0] == 5
    with pytest.raises(Exception, match="outside the matrix"):
        M.confusion_wide(M.confusion_long(df, "p", "a", 4), 4).collect()
    acc = M.accuracy_of_cells(M.cells(df, "p", "a")).first()
    assert acc["n"] == len(rows) and acc["accuracy_pct"] == 0.0


def test_macro_f1_union_of_seen(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "p int, a int")
    m = M.macro_f1(df, "p", "a").first()
    assert m["n_classes"] == 2 and abs(m["macro_f1"] - (2 / 3 + 2 / 3) / 2) < 1e-12


def test_parse_epoch_line(spark):
    lines = spark.createDataFrame([
        ("Epoch 1/1000",),
        ("232/232 [==============================] - 46s 183ms/step - loss: 1.9440 - "
         "sparse_categorical_accuracy: 0.3786 - val_loss: 1.3797 - val_sparse_categorical_accuracy: 0.5930",),
        ("116/232 [==============>...............] - ETA: 10s - loss: 1.1 - sparse_categorical_accuracy: 0.6",),
    ], "line string")
    r = LG.parse_epochs(lines).select("m0", "m1", "m2", "m3").collect()
    assert [tuple(x) for x in r] == [(1.944, 0.3786, 1.3797, 0.593)]


def test_parse_prediction_lines(spark):
    lines = spark.createDataFrame([
        ("normalizer.cc(51) LOG(INFO) precompiled_charsmap is empty.",),
        ("tensor([1], device='cuda:0') tensor([0], device='cuda:0')",),
        ("IE accuracy 89.06%",)], "line string")
    r = LG.parse_predictions(lines).select("pred", "target").collect()
    assert [tuple(x) for x in r] == [(1, 0)]
    r2 = LG.parse_predictions(lines, pred_first=False).select("pred", "target").collect()
    assert [tuple(x) for x in r2] == [(0, 1)]


def test_train_log_epochs(spark, tmp_path):
    text = "\n".join([
        "Train Epoch: 1 [0/4 (0%)]\tLoss: 0.5",
        "Train Epoch: 1 [2/4 (50%)]\tLoss: 0.7",
        "Epoch 1 finished.",
        "tensor([[2.0, -2.0]], device='cuda:0') tensor([[1., 0.]], device='cuda:0')",
        "tensor([[-1.0, 1.0]], device='cuda:0') tensor([[1., 0.]], device='cuda:0')",
        "Train Epoch: 2 [0/4 (0%)]\tLoss: 0.1",
        "Epoch 2 finished.",
        "tensor([[0.0, 0.0]], device='cuda:0') tensor([[0., 1.]], device='cuda:0')",
        "Train Epoch: 3 [0/4 (0%)]\tLoss: 0.9",
    ])
    p = tmp_path / "run.out"
    p.write_text(text + "\n")
    lines = LG.read_lines(spark, str(p))
    out = {r["epoch"]: r for r in LG.train_log_epochs(LG.classify_train_log(lines), ["log"]).collect()}
    assert sorted(out) == [1, 2]
    assert abs(out[1]["train_loss"] - 0.6) < 1e-12 and out[1]["n_eval"] == 2
    assert abs(out[1]["val_acc"] - 0.5) < 1e-12
    assert abs(out[2]["train_loss"] - 0.1) < 1e-12 and out[2]["n_eval"] == 1
    import math
    assert abs(out[2]["val_loss"] - (-math.log(0.5))) < 1e-9


def test_read_lines_numbers_across_files(spark, tmp_path):
    d = tmp_path / "log"
    df = spark.range(1000).select(F.col("id"), F.format_string("line %d", F.col("id")).alias("line"))
    LG.write_lines(df, str(d), ["id"], n_files=5)
    r = LG.read_lines(spark, str(d)).select("line_no", "line").collect()
    assert sorted((x["line_no"], x["line"]) for x in r) == [(i, f"line {i}") for i in range(1000)]


def test_read_lines_numbers_across_splits(spark, tmp_path):
    p = tmp_path / "big.log"
    p.write_text("".join(f"line {i} {'x' * (i % 37)}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = LG.read_lines(spark, str(p))
        assert df.rdd.getNumPartitions() > 5
        r = df.select("line_no", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((x["line_no"], x["line"]) for x in r) == [(i, f"line {i} {'x' * (i % 37)}") for i in range(3000)]
