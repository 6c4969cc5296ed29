"""Splits, seeded shuffles and positional cuts.

Randomness is a seeded hash of the row key (``md5(key || ':' || seed)``), so
every split is deterministic, order-free and reproducible on any cluster
size.  Per-class ranks come from ``group_row_number`` (range partitions), so
a class holding a third of the rows is still numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.operators.ranking import global_row_number, group_row_number


def seeded_key(key: str | Column, seed: int | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))


def seeded_int(key: str | Column, seed: int | str) -> Column:
    """A non-negative 60-bit integer from the seeded md5 of a key."""
    return F.conv(F.substring(seeded_key(key, seed), 1, 15), 16, 10).cast("bigint")


def stratified_test_sizes(counts: DataFrame, label_col: str, count_col: str = "n",
                          test_frac: float = 0.15) -> DataFrame:
    """Test rows per class for a stratified hold-out: ``n_test = ceil(f * n)``
    overall; the training rows ``n - n_test`` are apportioned to the classes by
    largest remainder (floor of ``c * n_train / n``, the missing rows to the
    largest fractional parts, ties to the smaller class value) and each class
    keeps the rest for test.  ``counts`` has one row per class (small)."""
    w_all = Window.partitionBy()
    n = F.sum(count_col).over(w_all)
    x = counts.select(label_col, F.col(count_col).alias("_c"), n.alias("_n"))
    x = x.withColumn("_ntr", F.col("_n") - F.ceil(F.col("_n") * test_frac))
    x = x.withColumn("_cont", F.col("_c") * F.col("_ntr") / F.col("_n"))
    x = x.withColumn("_fl", F.floor("_cont")).withColumn("_rem", F.col("_cont") - F.col("_fl"))
    need = F.col("_ntr") - F.sum("_fl").over(w_all)
    rk = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label_col)))
    x = x.withColumn("_alloc", F.col("_fl") + F.when(rk <= need, 1).otherwise(0))
    return x.select(label_col, (F.col("_c") - F.col("_alloc")).cast("long").alias("n_test"))


def split_stratified(df: DataFrame, id_col: str, label_col: str, test_frac: float = 0.15,
                     seed: int = 1) -> DataFrame:
    """Stratified seeded hold-out: per class, the ``n_test`` rows (see
    ``stratified_test_sizes``) first in seeded order go to test."""
    from lexis.operators.ranking import bounded_broadcast
    r = group_row_number(df.withColumn("_h", seeded_key(id_col, seed)), [label_col], ["_h", id_col],
                         "_rank", count_col="_n")
    counts = r.groupBy(label_col).agg(F.first("_n").alias("n"))
    sizes = stratified_test_sizes(counts, label_col, "n", test_frac)   # one row per class
    r = r.join(bounded_broadcast(sizes), label_col)
    return r.withColumn("split", F.when(F.col("_rank") < F.col("n_test"), "test").otherwise("train")) \
        .drop("_h", "_rank", "_n", "n_test")


def split_quota_head(df: DataFrame, id_col: str, label_col: str, pct: int = 15, seed: int = 1) -> DataFrame:
    """Per class take ``n*pct//100`` rows in seeded order ('test'), reshuffle
    them with a second seed and place them first; the rest follow in the first
    seeded order.  Adds ``split`` and a dense 0-based ``pos``."""
    r = group_row_number(df.withColumn("_h1", seeded_key(id_col, seed)), [label_col], ["_h1", id_col],
                         "_rank", count_col="_n")
    r = r.withColumn("_picked", F.col("_rank") < F.floor(F.col("_n") * pct / 100))
    r = r.withColumn("_h2", F.when(F.col("_picked"), seeded_key(id_col, f"{seed}b")).otherwise(F.col("_h1")))
    r = r.withColumn("_grp", F.when(F.col("_picked"), 0).otherwise(1))
    out = global_row_number(r, ["_grp", "_h2", id_col], "pos")
    return out.withColumn("split", F.when(F.col("_picked"), "test").otherwise("train")) \
        .drop("_h1", "_h2", "_grp", "_rank", "_n", "_picked")


def batch_split(df: DataFrame, pos_col: str = "pos", batch_size: int = 32, test_num: int = 3,
                test_den: int = 20) -> DataFrame:
    """Positional split by batches: the first ``n_batches*3//20`` batches are test."""
    n = df.count()                      # one scalar
    n_test = (-(-n // batch_size)) * test_num // test_den
    return df.withColumn("batch_no", F.floor(F.col(pos_col) / batch_size).cast("bigint")) \
        .withColumn("split", F.when(F.col("batch_no") < n_test, "test").otherwise("train"))


def split_overlap(df: DataFrame, label_col: str, order: list[str], disjoint: bool = False) -> DataFrame:
    """Per class: eval = first ``n//10+1`` rows, train = first ``n - eval``
    rows; both from the start, so eval is inside train (``disjoint=True`` takes
    eval from the end instead).  Output is train rows then eval rows, union all."""
    r = group_row_number(df, [label_col], order, "_rank", count_col="_n")
    ev = F.floor(F.col("_n") / 10) + 1
    tr = F.col("_n") - ev
    train = r.where(F.col("_rank") < tr).withColumn("part", F.lit("train"))
    cond = (F.col("_rank") >= tr) if disjoint else (F.col("_rank") < ev)
    evl = r.where(cond).withColumn("part", F.lit("eval"))
    return train.unionByName(evl).drop("_rank", "_n")


def bootstrap_exact(df: DataFrame, id_col: str, seed: int = 10, train_frac: float = 0.9) -> DataFrame:
    """Exactly n draws with replacement (draw i picks row ``hash(i, seed) mod n``),
    then the first ``int(0.9 n)`` draws are train and the rest eval."""
    spark = df.sparkSession
    idx = global_row_number(df.select(id_col), [id_col], "_row")
    n = df.count()
    draws = spark.range(n).select(F.col("id").alias("draw_no")) \
        .withColumn("_row", F.pmod(seeded_int("draw_no", seed), F.lit(n)))
    cut = int(train_frac * n)
    return draws.join(idx, "_row").select(
        "draw_no", id_col, F.when(F.col("draw_no") < cut, "train").otherwise("eval").alias("part"))


def shuffle_seeded(df: DataFrame, id_col: str, seed: int = 1) -> DataFrame:
    return global_row_number(df.withColumn("_h", seeded_key(id_col, seed)), ["_h", id_col], "pos").drop("_h")


def positional_cut(df: DataFrame, pos_col: str, cut: int) -> DataFrame:
    return df.withColumn("part", F.when(F.col(pos_col) < cut, "train").otherwise("eval"))
