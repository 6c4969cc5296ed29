"""Registered log queries (SRC-5..7, SEQ-1, EVL-8/9, SET-3, JN-5).

The logs are written as text by Spark from the driver tables (so the parse
has a real input that grows with the data) and read back from the shared
scratch folder below ``spark.checkpoint.dir``."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.operators import metrics as M
from lexis.operators import split as SP
from lexis.operators.ranking import group_row_number
from lexis.plans import sqlviews as S
from lexis.plans.q_metrics import _AX_CTE, _F1_SQL, _axis_scored, _grid_sql, _logits_sql
from lexis.plans.registry import query
from lexis.session import cut_lineage, scratch_path
from lexis.sources import logs as LG
from lexis.sources import tables as V


# --------------------------------------------------------------------------
# prediction logs, one file set per axis
# --------------------------------------------------------------------------
def write_prediction_logs(spark, d) -> str:
    """One job writes the four axis logs (``axis=<AX>/part-*``): a noise
    header, one ``tensor([P]) tensor([T])`` line per document in doc order,
    and a summary line."""
    base = scratch_path(spark, "pred-logs")
    s = _axis_scored(spark, d)
    parts = []
    for ax in L.AXES:
        a = ax.lower()
        parts.append(F.struct(F.lit(ax).alias("axis"), F.col(f"pred_{a}").alias("pred"), F.col(f"b_{a}").alias("t")))
    long = s.select("doc_id", F.explode(F.array(*parts)).alias("x")).select("doc_id", "x.*")
    # scored once: the range-partitioned write samples its input, and the
    # summary lines read it again
    long = cut_lineage(long)
    body = long.select("axis", F.lit(1).alias("k"), "doc_id", LG.format_prediction("pred", "t").alias("line"))
    summ = long.groupBy("axis").agg(F.sum((F.col("pred") == F.col("t")).cast("int")).alias("c"),
                                    F.count(F.lit(1)).alias("n"))
    tail = summ.select("axis", F.lit(2).alias("k"), F.lit(-1).cast("bigint").alias("doc_id"),
                       F.format_string("correct: %d, total: %d", "c", "n").alias("line"))
    head = summ.select("axis", F.lit(0).alias("k"), F.lit(-1).cast("bigint").alias("doc_id"),
                       F.lit("Some weights were not initialized from the checkpoint").alias("line"))
    LG.write_lines(head.unionByName(body).unionByName(tail), base, ["k", "doc_id"], partition_by="axis")
    return base


def parsed_prediction_logs(spark, d):
    base = write_prediction_logs(spark, d)
    lines = LG.read_lines(spark, [os.path.join(base, f"axis={ax}") for ax in L.AXES])
    p = LG.parse_predictions(lines, pred_first=True)
    p = p.withColumn("axis", F.regexp_extract("log", "axis=(IE|NS|FT|JP)$", 1))
    return group_row_number(p, ["axis"], ["line_no"], "pos")


@query("log_predictions", _AX_CTE + """
SELECT axis, row_number() OVER (PARTITION BY axis ORDER BY doc_id) - 1 AS pos, pred, target FROM lng""")
def log_predictions(spark, d):
    """Parse the four prediction logs (pred first), skip the noise lines and
    number the parsed lines per axis."""
    return parsed_prediction_logs(spark, d).select("axis", "pos", "pred", "target")


@query("log_predictions_target_first", _AX_CTE + """
SELECT axis, row_number() OVER (PARTITION BY axis ORDER BY doc_id) - 1 AS pos, pred, target FROM lng""")
def log_predictions_target_first(spark, d):
    """Writer variant that prints the target first: the same lines parsed
    with ``pred_first=False`` give back (pred, target)."""
    base = scratch_path(spark, "pred-logs-tf")
    s = _axis_scored(spark, d)
    parts = [F.struct(F.lit(ax).alias("axis"), F.col(f"pred_{ax.lower()}").alias("pred"),
                      F.col(f"b_{ax.lower()}").alias("t")) for ax in L.AXES]
    long = s.select("doc_id", F.explode(F.array(*parts)).alias("x")).select("doc_id", "x.*")
    lines = long.select("axis", "doc_id", LG.format_prediction("t", "pred").alias("line"))
    LG.write_lines(lines, base, ["doc_id"], partition_by="axis")
    r = LG.read_lines(spark, [os.path.join(base, f"axis={ax}") for ax in L.AXES])
    p = LG.parse_predictions(r, pred_first=False).withColumn("axis", F.regexp_extract("log", "axis=(IE|NS|FT|JP)$", 1))
    return group_row_number(p, ["axis"], ["line_no"], "pos").select("axis", "pos", "pred", "target")


@query("log_axis_f1", _AX_CTE + _F1_SQL)
def log_axis_f1(spark, d):
    """Per-axis tp/fp/fn/tn and F1 from the parsed (stacked) logs."""
    p = parsed_prediction_logs(spark, d)
    c = M.binary_counts(p, "pred", "target", ["axis"])
    out = c.select("axis", "tp", "fp", "fn", "tn", *M.f1_columns())
    return out.select("axis", "tp", "fp", "fn", "tn",
                      *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "f1_binary", "accuracy")])


@query("log_recombine", _AX_CTE + _grid_sql("rc", "actual_code", "pred_code"))
def log_recombine(spark, d):
    """Zip the four logs by parsed-line position, recombine the bits into a
    16-class code and count (rows = actual, columns = predicted)."""
    p = parsed_prediction_logs(spark, d)
    long = p.select(F.col("pos").alias("row_id"), "axis", "pred", "target")
    codes = M.recombine_axes(long, "row_id", {"pred": "pred_code", "target": "actual_code"})
    return M.confusion_long(codes, "pred_code", "actual_code", 16, rows="actual")


# --------------------------------------------------------------------------
# epoch metric log
# --------------------------------------------------------------------------
def _epoch_lines(spark, d):
    e = V.load(spark, d, "events").select("event_id", "event_type", "value", "user_id")
    prog = F.lit("232/232 [==============================] - ")
    full = F.concat(prog, F.lit("21s 91ms/step - loss: "), F.col("value").cast("string"),
                    F.lit(" - sparse_categorical_accuracy: "), (F.col("user_id") / 100.0).cast("string"),
                    F.lit(" - val_loss: "), (F.col("value") * 1.5).cast("string"),
                    F.lit(" - val_sparse_categorical_accuracy: "), (F.col("user_id") / 1000.0).cast("string"))
    partial = F.concat(prog, F.lit("ETA: 0s - loss: "), F.col("value").cast("string"),
                       F.lit(" - sparse_categorical_accuracy: "), (F.col("user_id") / 100.0).cast("string"))
    return e.select("event_id", F.when(F.col("event_type") == "click", partial).otherwise(full).alias("line"))


@query("log_epochs", """
WITH l AS (SELECT event_id, event_type, value, user_id, row_number() OVER (ORDER BY event_id) - 1 AS line_no FROM events)
SELECT line_no, round(value, 6) AS loss, round(user_id / 100.0, 6) AS accuracy, round(value * 1.5, 6) AS val_loss,
       round(user_id / 1000.0, 6) AS val_accuracy FROM l WHERE event_type <> 'click'""")
def log_epochs(spark, d):
    """Epoch-metric log: the four named metrics per line; partial progress
    lines (no validation metrics) drop out."""
    path = scratch_path(spark, "epoch-log")
    LG.write_lines(_epoch_lines(spark, d), path, ["event_id"])
    p = LG.parse_epochs(LG.read_lines(spark, path))
    return p.select("line_no", *[F.round(f"m{i}", 6).alias(n) for i, n in
                                 enumerate(["loss", "accuracy", "val_loss", "val_accuracy"])])


# --------------------------------------------------------------------------
# training log with epoch markers and evaluation tensors
# --------------------------------------------------------------------------
N_EPOCHS = 2


def _train_log_lines(spark, d):
    """The four axis training logs as one DataFrame (axis, epoch, sec, doc_id,
    line): per epoch, one loss line per training document, the epoch marker,
    then one logit/target line per evaluation document."""
    sc = _axis_scored(spark, d)
    parts = [F.struct(F.lit(ax).alias("axis"), F.col(f"logit_{ax.lower()}").alias("logit"),
                      F.col(f"b_{ax.lower()}").alias("t")) for ax in L.AXES]
    s = sc.select("doc_id", F.explode(F.array(*parts)).alias("x")).select("doc_id", "x.*")
    # stratified per axis and target, seeded by the document key
    r = group_row_number(s.withColumn("_h", SP.seeded_key("doc_id", 3)), ["axis", "t"], ["_h", "doc_id"], "_rk",
                         count_col="_n")
    sp = r.withColumn("split", F.when(F.col("_rk") < F.ceil(F.col("_n") * 0.15), "test").otherwise("train"))
    n_train = sp.where("split = 'train'").groupBy("axis").agg(F.count(F.lit(1)).alias("n_train"))
    x = sp.join(F.broadcast(n_train), "axis") \
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(N_EPOCHS))))  # one log pass per epoch
    lg = F.col("logit") * F.col("epoch") / 2.0
    train = x.where("split = 'train'").select(
        "axis", "epoch", F.lit(0).alias("sec"), "doc_id",
        F.concat(F.lit("Train Epoch: "), F.col("epoch").cast("string"), F.lit(" [x/"), F.col("n_train").cast("string"),
                 F.lit(" (0%)]\tLoss: "), M.bce_terms(lg, F.col("t").cast("double")).cast("string")).alias("line"))
    marks = n_train.select("axis", F.explode(F.sequence(F.lit(1), F.lit(N_EPOCHS))).alias("epoch")).select(
        "axis", "epoch", F.lit(1).alias("sec"), F.lit(-1).cast("bigint").alias("doc_id"),
        F.concat(F.lit("Epoch "), F.col("epoch").cast("string"), F.lit(" finished.")).alias("line"))
    evl = x.where("split = 'test'").select(
        "axis", "epoch", F.lit(2).alias("sec"), "doc_id",
        F.concat(F.lit("tensor([["), lg.cast("string"), F.lit(", "), (-lg).cast("string"),
                 F.lit("]], device='cuda:0') tensor([["), F.col("t").cast("string"), F.lit(".0, "),
                 (1 - F.col("t")).cast("string"), F.lit(".0]], device='cuda:0')")).alias("line"))
    return train.unionByName(marks).unionByName(evl)


def train_log_metrics(spark, d):
    base = scratch_path(spark, "train-logs")
    LG.write_lines(_train_log_lines(spark, d), base, ["epoch", "sec", "doc_id"], partition_by="axis")
    lines = LG.read_lines(spark, [os.path.join(base, f"axis={ax}") for ax in L.AXES])
    lines = lines.withColumn("axis", F.regexp_extract("log", "axis=(IE|NS|FT|JP)$", 1))
    c = LG.classify_train_log(lines).join(lines.select("log", "line_no", "axis"), ["log", "line_no"])
    return LG.train_log_epochs(c, ["axis"])


def _train_sql() -> str:
    parts = []
    for ax in L.AXES:
        a = ax.lower()
        parts.append(f"SELECT '{ax}' AS axis, doc_id, logit_{a} AS logit, b_{a} AS t FROM lg")
    lgt = "(logit * e.epoch / 2.0)"
    bce = (f"-(t * greatest(ln(1.0 / (1.0 + exp(-{lgt}))), -100.0) + (1.0 - t) * "
           f"greatest(ln(1.0 - 1.0 / (1.0 + exp(-{lgt}))), -100.0))")
    return S.with_(S.AXES_CTE, f"""
lg AS ({_scored_from_axes()}),
al AS ({' UNION ALL '.join(parts)}),
r AS (SELECT *, row_number() OVER (PARTITION BY axis, t ORDER BY md5(CAST(doc_id AS VARCHAR) || ':3'), doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY axis, t) AS n FROM al),
sp AS (SELECT *, CASE WHEN rk < ceil(n * 0.15) THEN 'test' ELSE 'train' END AS split FROM r),
e AS (SELECT CAST(x AS INTEGER) AS epoch FROM range(1, {N_EPOCHS + 1}) t(x)),
v AS (SELECT sp.axis, e.epoch, sp.split, {bce} AS bce,
             CAST(CAST(1.0 / (1.0 + exp(-{lgt})) >= 0.5 AS INTEGER) = t AS DOUBLE) AS ok FROM sp, e)""") + """
SELECT axis, epoch, round(avg(bce) FILTER (WHERE split = 'train'), 6) AS train_loss,
       count(*) FILTER (WHERE split = 'train') AS n_loss,
       round(avg(bce) FILTER (WHERE split = 'test'), 6) AS val_loss,
       round(avg(ok) FILTER (WHERE split = 'test'), 6) AS val_acc,
       count(*) FILTER (WHERE split = 'test') AS n_eval
FROM v GROUP BY axis, epoch"""


def _scored_from_axes() -> str:
    lg = _logits_sql("text")
    cols = ", ".join(f"{x} AS logit_{a.lower()}" for x, a in zip(lg, L.AXES))
    return f"SELECT doc_id, b_ie, b_ns, b_ft, b_jp, {cols} FROM axes"


@query("bce_by_epoch", _train_sql())
def bce_by_epoch(spark, d):
    """Training logs: mean train loss per epoch (epochs numbered by the
    ``finished.`` markers), mean BCE and accuracy of the logged eval logits."""
    m = train_log_metrics(spark, d)
    return m.select("axis", F.col("epoch").cast("int").alias("epoch"), F.round("train_loss", 6).alias("train_loss"),
                    "n_loss", F.round("val_loss", 6).alias("val_loss"), F.round("val_acc", 6).alias("val_acc"), "n_eval")


@query("log_train_loss", "SELECT axis, epoch, train_loss, n_loss FROM (" + _train_sql() + ")")
def log_train_loss(spark, d):
    m = bce_by_epoch(spark, d)
    return m.select("axis", "epoch", "train_loss", "n_loss")

