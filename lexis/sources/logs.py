"""Text-log sources: write line tables as text, read text back with exact
line numbers, and parse prediction, epoch-metric and training logs.

Line numbers are exact without a single-task scan: lines are ordered by
(file, block start, position inside the block): a line's number is the offset
of its file split (a prefix sum over one count per split) plus its position.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.operators.ranking import global_running


def write_lines(df: DataFrame, path: str, order: list[str], line_col: str = "line",
                n_files: int | None = None, partition_by: str | None = None) -> None:
    """Write ``line_col`` as text, files and lines in ``order`` (range-partitioned,
    so part file i holds the i-th key range).  With ``partition_by`` one job
    writes one log folder per value (``<col>=<value>/part-*``)."""
    n = n_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    keys = ([partition_by] if partition_by else []) + list(order)
    w = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    if partition_by:
        w.select(partition_by, line_col).write.mode("overwrite").partitionBy(partition_by).text(path)
    else:
        w.select(line_col).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, log, line_no, line) for text logs.  A log is a folder of part
    files written by ``write_lines`` (or a single file); ``line_no`` is 0-based
    across the log's files in name order.

    Exact without a sort of the lines: every file split (file, block start) is
    read in order by one task, so a row's place inside its split is its id
    minus the split's first id; the splits' line counts (one row per split,
    bounded by the file listing) are prefix-summed per log and broadcast."""
    from pyspark.sql import Window
    raw = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.input_file_block_start().alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"), F.col("value").alias("line"))
    raw = raw.withColumn("log", F.when(F.col("file").rlike(r"/part-[^/]*$"),
                                       F.regexp_replace("file", r"/[^/]*$", "")).otherwise(F.col("file")))
    splits = raw.groupBy("log", "file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy("log").orderBy("file", "_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("log", "file", "_blk", "_m0",
                           F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = raw.join(F.broadcast(splits), ["log", "file", "_blk"])
    return out.select("file", "log", (F.col("_off") + F.col("_mid") - F.col("_m0")).alias("line_no"), "line")


# ---------------------------------------------------------------------------
# prediction logs: "tensor([P], device=...) tensor([T], device=...)"
# ---------------------------------------------------------------------------
_PRED_RE = r"tensor\(\[(\d).*?tensor\(\[(\d)"


def parse_predictions(lines: DataFrame, pred_first: bool = True) -> DataFrame:
    """Keep lines with two ``tensor([d`` groups; other lines are skipped.
    ``pred_first`` selects the writer's order (pred then target, or reverse)."""
    ok = lines.where(F.col("line").rlike(_PRED_RE))
    a = F.regexp_extract("line", _PRED_RE, 1).cast("int")
    b = F.regexp_extract("line", _PRED_RE, 2).cast("int")
    pred, target = (a, b) if pred_first else (b, a)
    return ok.select("*", pred.alias("pred"), target.alias("target"))


def format_prediction(pred, target) -> Column:
    return F.format_string("tensor([%d], device='cuda:0') tensor([%d], device='cuda:0')", pred, target)


# ---------------------------------------------------------------------------
# epoch metric logs: "... - loss: a - accuracy: b - val_loss: c - val_accuracy: d"
# ---------------------------------------------------------------------------
EPOCH_KEYS = ["loss", "sparse_categorical_accuracy", "val_loss", "val_sparse_categorical_accuracy"]


def parse_epochs(lines: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """For every key: the text after the first ``key: `` up to `` -`` or the
    line end, as a double; lines where any key is missing or not a number
    (e.g. a partial progress line) are dropped."""
    keys = keys or EPOCH_KEYS
    out = lines
    names = []
    for i, k in enumerate(keys):
        v = F.regexp_extract("line", re.escape(k) + r": (.*?)(?: -|$)", 1)
        name = f"m{i}"
        out = out.withColumn(name, F.when(F.col("line").contains(k + ": "), v.try_cast("double")))
        names.append(name)
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return out.where(cond)


# ---------------------------------------------------------------------------
# training logs: "Loss: x" lines, "Epoch i finished." markers, then
# "tensor([[logit, ..]]) tensor([[target, ..]])" evaluation lines
# ---------------------------------------------------------------------------
_EVAL_RE = r"tensor\(\[\[([^,\]]*)[,\]].*?\) tensor\(\[\[([^,\]]*)[,\]]"


def classify_train_log(lines: DataFrame) -> DataFrame:
    """Adds is_loss/loss, is_marker, logit/target (eval lines) and, per line,
    the epoch block it belongs to; ``lines`` carries (file, line_no, line)."""
    x = lines.select(
        "log", "line_no", "line",
        F.col("line").contains("Loss: ").alias("is_loss"),
        F.try_element_at(F.split(F.col("line"), "Loss: ", -1), F.lit(2)).try_cast("double").alias("loss"),
        F.col("line").contains("finished.").alias("is_marker"),
        F.regexp_extract("line", _EVAL_RE, 1).try_cast("double").alias("logit"),
        F.regexp_extract("line", _EVAL_RE, 2).try_cast("double").alias("target"))
    x = x.withColumn("is_eval", F.col("logit").isNotNull() & F.col("target").isNotNull())
    pos = F.struct(F.col("log").alias("l"), F.col("line_no").alias("n"))
    # one pass: running marker count, last marker and last non-eval line (as
    # (log, line) positions) in log order
    g = global_running(x, ["log", "line_no"],
                       sums={"_markers_cum": F.col("is_marker").cast("int")},
                       maxes={"_last_marker": F.when(F.col("is_marker"), pos),
                              "_last_break": F.when(~F.col("is_eval"), pos)})
    # markers before each log (one row per log: bounded by the file listing)
    first = g.groupBy("log").agg(F.min(F.col("_markers_cum") - F.col("is_marker").cast("int")).alias("_m0"))
    base = g.join(F.broadcast(first), "log")
    epoch_of_line = (F.col("_markers_cum") - F.col("_m0"))
    in_file = F.col("_last_marker.l") == F.col("log")
    return base.select(
        "log", "line_no", "is_loss", "loss", "is_marker", "is_eval", "logit", "target",
        # a loss line belongs to the epoch that its next marker finishes
        (epoch_of_line + 1).alias("train_epoch"),
        # an eval line belongs to the last marker when no break line lies between
        F.when(F.col("is_eval") & in_file & (F.col("_last_break") == F.col("_last_marker")), epoch_of_line)
        .alias("eval_epoch"))


def train_log_epochs(classified: DataFrame, group: list[str]) -> DataFrame:
    """Per finished epoch: mean train loss, mean BCE of the eval logits (log
    terms clamped at -100), eval accuracy at 0.5, eval count."""
    from lexis.operators.metrics import bce_terms
    n_marks = classified.where("is_marker").groupBy(*group).agg(F.count(F.lit(1)).alias("_n_epochs"))
    tl = classified.where(F.col("is_loss") & F.col("loss").isNotNull()) \
        .groupBy(*group, F.col("train_epoch").alias("epoch")) \
        .agg(F.avg("loss").alias("train_loss"), F.count(F.lit(1)).alias("n_loss"))
    ev = classified.where(F.col("eval_epoch").isNotNull()) \
        .groupBy(*group, F.col("eval_epoch").alias("epoch")) \
        .agg(F.avg(bce_terms("logit", "target")).alias("val_loss"),
             F.avg(((F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))) >= 0.5).cast("double")
                    == F.col("target")).cast("double")).alias("val_acc"),
             F.count(F.lit(1)).alias("n_eval"))
    out = tl.join(ev, [*group, "epoch"], "full").join(n_marks, group)
    return out.where((F.col("epoch") >= 1) & (F.col("epoch") <= F.col("_n_epochs"))).drop("_n_epochs")
