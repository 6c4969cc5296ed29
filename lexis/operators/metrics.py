"""Evaluation metrics: confusion matrices (long, wide, soft), binary and macro
F1, accuracy, BCE, and recombination of per-axis predictions.

All metrics are aggregates with partial (map-side) combine; dense grids come
from ``spark.range`` (n_classes^2 rows), never from data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions import labels as L


#: Row or column of a confusion grid for NULL and out-of-range classes.
OTHER = -1


def cells(df: DataFrame, pred_col: str, actual_col: str, group: list[str] | None = None) -> DataFrame:
    """Counts of each (group, pred, actual): one partial + final aggregate, at
    most classes^2 rows a group.  All metrics below can start from these."""
    return df.groupBy(*(group or []), F.col(pred_col).cast("int").alias("pred"), F.col(actual_col).cast("int").alias("actual")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_long(df: DataFrame, pred_col: str, actual_col: str, n_classes: int = 16,
                   rows: str = "pred") -> DataFrame:
    """Dense (row, col, n) grid; ``rows='pred'`` puts predictions on rows (the
    default), ``rows='actual'`` transposes.  No input row is lost: NULL or
    out-of-range classes are counted in row or column ``OTHER`` (-1), which is
    present only if there are any."""
    def inside(c: str) -> Column:
        return F.when((F.col(c) >= 0) & (F.col(c) < n_classes), F.col(c)).otherwise(OTHER).cast("int")
    r, c = ("pred", "actual") if rows == "pred" else ("actual", "pred")
    counts = cells(df, pred_col, actual_col).select(inside(r).alias("row"), inside(c).alias("col"), "n")
    grid = df.sparkSession.range(n_classes * n_classes).select(
        (F.col("id") / n_classes).cast("int").alias("row"), (F.col("id") % n_classes).cast("int").alias("col"),
        F.lit(0).cast("bigint").alias("n"))
    return grid.union(counts).groupBy("row", "col").agg(F.sum("n").alias("n"))


def confusion_wide(long_df: DataFrame, n_classes: int = 16, value_col: str = "n") -> DataFrame:
    """Pivot a dense long matrix to one row per matrix row and columns c0..c{n-1}
    (an ``OTHER`` row stays; an ``OTHER`` column has no place here and fails)."""
    col = F.when(F.col("col") == OTHER, F.raise_error(F.lit("predicted or actual class outside the matrix"))).otherwise(F.col("col"))
    w = long_df.withColumn("col", col.cast("int")).groupBy("row").pivot("col", list(range(n_classes))).agg(F.first(value_col))
    return w.select("row", *[F.col(str(i)).alias(f"c{i}") for i in range(n_classes)])


def confusion_soft(df: DataFrame, actual_col: str, probs_col: str) -> DataFrame:
    """Sum of class probabilities per actual class: (actual, class, p_sum)."""
    x = df.select(F.col(actual_col).cast("int").alias("actual"), F.posexplode(probs_col).alias("class", "p"))
    return x.groupBy("actual", "class").agg(F.sum("p").alias("p_sum"))


def binary_counts(df: DataFrame, pred_col: str, target_col: str, group: list[str] | None = None) -> DataFrame:
    p, t = F.col(pred_col), F.col(target_col)
    aggs = [F.count_if((p == 1) & (t == 1)).alias("tp"), F.count_if((p == 1) & (t == 0)).alias("fp"),
            F.count_if((p == 0) & (t == 1)).alias("fn"), F.count_if((p == 0) & (t == 0)).alias("tn")]
    return df.groupBy(*(group or [])).agg(*aggs)


def f1_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> list[Column]:
    """precision / recall / f1 (NULL where a ratio is undefined), the library
    convention f1_binary (0 when undefined) and accuracy."""
    tp, fp, fn, tn = (F.col(x) for x in (tp, fp, fn, tn))
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    f1 = F.try_divide(prec * rec * 2, prec + rec)
    return [prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
            F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), F.lit(0.0)).alias("f1_binary"),
            ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy")]


def per_class_f1(counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """One-vs-rest F1 per class over the union of seen labels (0 when undefined),
    from ``cells``: every cell counts for its predicted and its actual class."""
    g = group or []
    hit = F.when(F.col("pred").eqNullSafe(F.col("actual")), F.col("n")).otherwise(0)
    each = counts.select(*g, F.inline(F.array(
        F.struct(F.col("pred").alias("cls"), hit.alias("tp"), F.col("n").alias("n_pred"), F.lit(0).cast("bigint").alias("n_act")),
        F.struct(F.col("actual").alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("n_pred"),
                 F.col("n").alias("n_act")))))
    j = each.groupBy(*g, "cls").agg(*[F.sum(x).alias(x) for x in ("tp", "n_pred", "n_act")])
    return j.withColumn("f1", F.coalesce(F.try_divide(F.col("tp") * 2, F.col("n_pred") + F.col("n_act")), F.lit(0.0)))


def macro_f1_of_cells(counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    return per_class_f1(counts, group).groupBy(*(group or [])).agg(
        F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("n_classes"))


def macro_f1(df: DataFrame, pred_col: str, actual_col: str, group: list[str] | None = None) -> DataFrame:
    return macro_f1_of_cells(cells(df, pred_col, actual_col, group), group)


def accuracy_of_cells(counts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Accuracy in % from ``cells`` (a NULL class is never right, but counts)."""
    right = F.sum(F.when(F.col("pred") == F.col("actual"), F.col("n")).otherwise(0))
    return counts.groupBy(*(group or [])).agg((right * 100 / F.sum("n")).alias("accuracy_pct"), F.sum("n").alias("n"))


def accuracy_pct(df: DataFrame, pred_col: str, actual_col: str, group: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(group or [])).agg(
        (F.avg((F.col(pred_col) == F.col(actual_col)).cast("double")) * 100).alias("accuracy_pct"),
        F.count(F.lit(1)).alias("n"))


def bce_terms(logit, target) -> Column:
    """Binary cross-entropy of sigmoid(logit) vs target, log terms clamped at -100."""
    x = F.col(logit) if isinstance(logit, str) else logit
    t = F.col(target) if isinstance(target, str) else target
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    lp = F.greatest(F.log(p), F.lit(-100.0))
    l1p = F.greatest(F.log(F.lit(1.0) - p), F.lit(-100.0))
    return -(t * lp + (F.lit(1.0) - t) * l1p)


def recombined(df: DataFrame, id_col: str, pred_cols: list[str], target_cols: list[str]) -> DataFrame:
    """Per row the predicted and actual code B (alphabetical index) =
    ((8*ie + 4*ns + 2*ft + jp) + 8) % 16, by arithmetic on the wide row."""
    return df.select(id_col, L.flip(L.code_from_bits(*pred_cols)).alias("pred_code"),
                     L.flip(L.code_from_bits(*target_cols)).alias("actual_code"))


def scope_cells(df: DataFrame, pred_cols: list[str], target_cols: list[str]) -> DataFrame:
    """``cells`` per axis and, as scope ALL, of the recombined codes: one pass over the wide rows."""
    parts = [F.struct(F.lit(a).alias("scope"), F.col(p).cast("int").alias("pred"), F.col(t).cast("int").alias("actual"))
             for a, p, t in zip(L.AXES, pred_cols, target_cols)]
    parts.append(F.struct(F.lit("ALL").alias("scope"), L.flip(L.code_from_bits(*pred_cols)).cast("int").alias("pred"),
                          L.flip(L.code_from_bits(*target_cols)).cast("int").alias("actual")))
    return cells(df.select(F.inline(F.array(*parts))), "pred", "actual", ["scope"])


def recombine_axes(long_df: DataFrame, id_col: str, values: dict[str, str]) -> DataFrame:
    """Per row of a long (id, axis, ...) table: the bits of each value column
    combined into code B (alphabetical index) = ((8*ie + 4*ns + 2*ft + jp) + 8) % 16,
    in one aggregate.  ``values`` maps value columns to the names of their codes."""
    weight = F.element_at(F.create_map(*[F.lit(x) for i, a in enumerate(L.AXES) for x in (a, 8 >> i)]), F.col("axis"))
    g = long_df.groupBy(id_col).agg(*[F.sum(F.col(v) * weight).cast("int").alias(name) for v, name in values.items()])
    return g.select(id_col, *[L.flip(name).alias(name) for name in values.values()])
