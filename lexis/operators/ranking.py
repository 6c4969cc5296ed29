"""Distributed global numbering (no single-partition window).

``Window.orderBy(...)`` without ``partitionBy`` funnels every row through one
task.  Instead: range-partition on the order key, freeze the partitioning
with a reliable checkpoint, count rows per partition (one row per partition),
turn the counts into offsets on that tiny table (bounded by the partition
count) and number rows locally inside each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.session import cut_lineage


def _parts(df: DataFrame, n_parts: int | None) -> int:
    if n_parts:
        return n_parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_row_number(df: DataFrame, order: list[Column | str], out_col: str = "row_no",
                      n_parts: int | None = None, keep_part: bool = False) -> DataFrame:
    """0-based position of each row in the total order ``order`` (must be a total
    order for a deterministic result).

    One range shuffle: rows are sorted inside each range partition and take
    their index inside it from ``monotonically_increasing_id`` (partition id in
    the upper bits, position below) before the checkpoint freezes the result;
    per-partition counts (one row per partition) become offsets."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    r = df.repartitionByRange(_parts(df, n_parts), *cols).sortWithinPartitions(*cols) \
        .withColumn("_p", F.spark_partition_id()) \
        .withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    r = cut_lineage(r)
    cnt = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = cnt.select("_p", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = r.join(F.broadcast(offs), "_p").withColumn(out_col, F.col("_off") + F.col("_i"))  # <= n_parts rows
    return out.drop("_off", "_i") if keep_part else out.drop("_p", "_off", "_i")


def global_dense_rank(df: DataFrame, cols: list[str], out_col: str = "rank",
                      n_parts: int | None = None) -> DataFrame:
    """0-based dense rank of ``cols`` (ascending): number the distinct values
    with ``global_row_number`` and join the numbers back."""
    keys = global_row_number(df.select(*cols).distinct(), cols, out_col, n_parts)
    return df.join(bounded_broadcast(keys), cols, "left")


def global_running_sum(df: DataFrame, order: list[Column | str], value: Column | str, out_col: str,
                       n_parts: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in the total order ``order``."""
    v = F.col(value) if isinstance(value, str) else value
    return global_running(df, order, sums={out_col: v}, n_parts=n_parts)


def group_row_number(df: DataFrame, group: list[str], order: list[Column | str], out_col: str = "rank",
                     n_parts: int | None = None, count_col: str | None = None,
                     broadcast_rows: int = 1_000_000) -> DataFrame:
    """0-based row number inside each group, without a per-group window.

    Rows are numbered globally over ``group + order`` (range partitions split
    a hot group across many tasks); the group's first global number is then
    subtracted.  The starts are joined back on (partition, group), so a hot
    group's rows stay spread over their partitions; that table has at most
    partitions + groups rows and is broadcast only when its counted size is
    below ``broadcast_rows`` (a shuffled join otherwise).  Exact for any
    group size."""
    g = global_row_number(df, [*group, *order], "_g", n_parts, keep_part=True)
    per = g.groupBy("_p", *group).agg(F.min("_g").alias("_gp"), F.count(F.lit(1)).alias("_np"))
    starts = per.groupBy(*group).agg(F.min("_gp").alias("_g0"), F.sum("_np").alias("_gn"))
    tbl = per.join(starts, group).select("_p", *group, "_g0", "_gn")
    if tbl.count() <= broadcast_rows:
        tbl = F.broadcast(tbl)
    out = g.join(tbl, ["_p", *group]).withColumn(out_col, F.col("_g") - F.col("_g0"))
    out = out.withColumnRenamed("_gn", count_col) if count_col else out.drop("_gn")
    return out.drop("_g", "_g0", "_p")


def global_running_max(df: DataFrame, order: list[Column | str], value: Column | str, out_col: str,
                       n_parts: int | None = None) -> DataFrame:
    """Inclusive running max of ``value`` (nulls ignored) in the total order ``order``."""
    v = F.col(value) if isinstance(value, str) else value
    return global_running(df, order, maxes={out_col: v}, n_parts=n_parts)


def bounded_broadcast(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast ``df`` only when its counted size is at most ``max_rows``;
    otherwise return it unchanged (a shuffled join, skew-split by AQE).  Meant
    for already materialised tables (checkpointed), where the count is cheap."""
    return F.broadcast(df) if df.count() <= max_rows else df


def global_running(df: DataFrame, order: list[Column | str], sums: dict | None = None, maxes: dict | None = None,
                   row_col: str | None = None, n_parts: int | None = None) -> DataFrame:
    """Several inclusive running aggregates (sums, maxima ignoring nulls) and
    optionally the 0-based row position, in the total order ``order``, in one
    pass: one range shuffle + checkpoint, per-partition totals (one row per
    partition) turned into offsets, and one window over each range partition."""
    sums, maxes = dict(sums or {}), dict(maxes or {})
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if row_col:
        sums[row_col] = F.lit(1)
    r = df
    for i, (name, c) in enumerate({**sums, **maxes}.items()):
        r = r.withColumn(f"_v{i}", c)
    keys = list({**sums, **maxes})
    r = r.repartitionByRange(_parts(df, n_parts), *cols).withColumn("_p", F.spark_partition_id())
    r = cut_lineage(r)
    aggs = [(F.sum if k in sums else F.max)(f"_v{i}").alias(f"_t{i}") for i, k in enumerate(keys)]
    tot = r.groupBy("_p").agg(*aggs)
    wp = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_p", *[(F.coalesce(F.sum(f"_t{i}").over(wp), F.lit(0)) if k in sums
                               else F.max(f"_t{i}").over(wp)).alias(f"_o{i}") for i, k in enumerate(keys)])
    w = Window.partitionBy("_p").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    out = r.join(F.broadcast(offs), "_p", "left")   # <= n_parts rows
    for i, k in enumerate(keys):
        if k in sums:
            out = out.withColumn(k, F.col(f"_o{i}") + F.sum(f"_v{i}").over(w))
        else:
            out = out.withColumn(k, F.greatest(F.col(f"_o{i}"), F.max(f"_v{i}").over(w)))
    if row_col:
        out = out.withColumn(row_col, F.col(row_col) - 1)
    return out.drop("_p", *[f"_v{i}" for i in range(len(keys))], *[f"_o{i}" for i in range(len(keys))])
