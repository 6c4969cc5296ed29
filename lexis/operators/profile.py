"""Profiling aggregates: class counts, axis counts, fixed-width histograms.

Every aggregate is a partial (map-side) + final hash aggregate, so a hot key
costs one pre-aggregated row per task, never a skewed shuffle of raw rows.
Zero-filled histogram grids come from ``spark.range`` (fixed size), not data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.functions import text as T

N_BUCKETS = 60


def bucket_grid(spark: SparkSession, width: int, n_buckets: int = N_BUCKETS) -> DataFrame:
    """``n_buckets`` labelled buckets ``lo-hi`` plus one overflow bucket ``lo+``."""
    g = spark.range(n_buckets + 1).select(F.col("id").cast("int").alias("bucket"))
    lo = F.col("bucket") * width
    return g.select("bucket", F.when(F.col("bucket") < n_buckets,
                                     F.concat_ws("-", lo.cast("string"), (lo + width).cast("string")))
                    .otherwise(F.concat(lo.cast("string"), F.lit("+"))).alias("post_length"))


def bucket_of(n, width: int, n_buckets: int = N_BUCKETS):
    return F.least(F.floor(F.col(n) / width).cast("int") if isinstance(n, str) else F.floor(n / width).cast("int"),
                   F.lit(n_buckets))


def histogram(df: DataFrame, n_col: str, width: int, n_buckets: int = N_BUCKETS) -> DataFrame:
    """Zero-filled fixed-width histogram of an integer column: (bucket, post_length, count)."""
    counts = df.groupBy(bucket_of(n_col, width, n_buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    grid = bucket_grid(df.sparkSession, width, n_buckets)
    return grid.join(F.broadcast(counts), "bucket", "left").select(
        "bucket", "post_length", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def person_word_counts(post_rows: DataFrame) -> DataFrame:
    """``len(posts.split(' '))`` per person without building the joined text:
    joining n posts with ``|||`` merges n-1 boundary words, so the person count
    is ``sum(parts) - (n - 1)`` — a partial aggregate, safe for hot persons."""
    return post_rows.groupBy("person_id").agg(
        (F.sum(T.space_parts("post")) - F.count(F.lit(1)) + 1).alias("n_words"))


def hist_before_after(persons: DataFrame, clean_col: str = "clean", raw_col: str = "posts",
                      width: int = 50) -> DataFrame:
    """Histogram of person word counts before and after cleaning, side by side,
    computed in one pass with two conditional counts."""
    n_b = bucket_of(T.space_parts(raw_col), width)
    n_a = bucket_of(T.space_parts(clean_col), width)
    stacked = persons.select(F.explode(F.array(
        F.struct(n_b.alias("bucket"), F.lit(1).alias("is_before")),
        F.struct(n_a.alias("bucket"), F.lit(0).alias("is_before")))).alias("s")).select("s.*")
    counts = stacked.groupBy("bucket").agg(
        F.count_if(F.col("is_before") == 1).alias("before"),
        F.count_if(F.col("is_before") == 0).alias("after"))
    grid = bucket_grid(persons.sparkSession, width)
    return grid.join(F.broadcast(counts), "bucket", "left").select(
        "bucket", "post_length",
        F.coalesce("before", F.lit(0)).cast("bigint").alias("before"),
        F.coalesce("after", F.lit(0)).cast("bigint").alias("after"))


def count_by_type(df: DataFrame, label_col: str = "type", value_col: str = "posts") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(value_col).alias("n"))


def distinct_types(df: DataFrame, label_col: str = "type") -> DataFrame:
    return df.select(label_col).where(F.col(label_col).isNotNull()).distinct()


def table_shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("int").alias("n_cols"))


def axis_counts(df: DataFrame, label_col: str = "type") -> DataFrame:
    """Rows per axis letter: one aggregate of eight conditional counts."""
    aggs = []
    for i, (lo, hi) in enumerate(L.AXIS_LETTERS):
        b = L.bit(label_col, i)
        aggs += [F.count_if(b == 0).alias(f"n_{lo}"), F.count_if(b == 1).alias(f"n_{hi}")]
    return df.agg(*aggs)


def _run_stats(f, prefix: str) -> list:
    """Space-run features of a cleaned post needed to count spaces after the
    separators are collapsed."""
    return [F.size(F.regexp_extract_all(f, F.lit("[^ ] "), F.lit(0))).alias(f"{prefix}_starts"),
            F.size(F.regexp_extract_all(f, F.lit(T.U + r"([^\S ])\1+"), F.lit(0))).alias(f"{prefix}_runs"),
            F.startswith(f, F.lit(" ")).alias(f"{prefix}_lead"),
            F.endswith(f, F.lit(" ")).alias(f"{prefix}_trail"),
            (F.length(f) == 0).alias(f"{prefix}_empty"),
            T.word_count_regex(f).alias(f"{prefix}_words")]


def person_clean_word_counts(post_rows: DataFrame) -> DataFrame:
    """Per person: word count before and after the profile clean, computed from
    the posts alone (no joined person text, so a person with a third of all
    posts is still spread over many tasks).

    The joined text is ``p1 |||p2 ||| ... pn``.  Every clean step is local to
    a post except three: the separators turn into runs of spaces, the
    tripled-letter step cuts everything after the first tripled letter of the
    person (later posts and separators included), and whitespace runs collapse
    across separators.  So each post is cleaned alone (with one trailing space
    standing for the first separator character) into a few integer features —
    for the post kept whole and for the post cut at its tripled letter — and
    those small rows are checkpointed, so the regex work runs once.  The first
    post with a tripled letter is a min aggregate, and the space count of the
    final text is assembled from the features:

        words_after = 1 + #spaces(final)
        #spaces     = space runs (each collapses to one space, single spaces stay)
                    + runs of 2+ equal non-space whitespace (each becomes a space)
    """
    from lexis.session import cut_lineage
    x = T.url_strip_ws(F.col("post"))
    for ch, tok in ((c, f" {t} ") for c, t in T.END_MARKS.items()):
        x = F.replace(x, F.lit(ch), F.lit(tok))
    e = F.lower(T.letters_only(T.strip_punct(x)))
    p = post_rows.select("person_id", "post_no", T.space_parts("post").alias("parts"), e.alias("e"))
    full = T.drop_long_words(T.drop_short_words(F.col("e")))
    cut = T.drop_long_words(T.drop_short_words(T.triple_truncate(F.col("e"))))
    feats = p.select("person_id", "post_no", "parts", F.col("e").rlike(T.U + r"([a-z])\1{2,}").alias("has_triple"),
                     *_run_stats(full, "w"), *_run_stats(cut, "c"))
    feats = cut_lineage(feats)
    per = feats.groupBy("person_id").agg(
        F.min(F.when(F.col("has_triple"), F.col("post_no"))).alias("cut_post"),
        F.min("post_no").alias("first_post"),
        (F.sum("parts") - F.count(F.lit(1)) + 1).alias("n_before"))
    k = feats.join(per, "person_id").where(F.col("cut_post").isNull() | (F.col("post_no") <= F.col("cut_post")))
    is_cut = F.col("post_no").eqNullSafe(F.col("cut_post"))
    is_first = F.col("post_no") == F.col("first_post")

    def pick(name):
        return F.when(is_cut, F.col(f"c_{name}")).otherwise(F.col(f"w_{name}"))
    lead = (is_first & pick("lead")).cast("int")
    # the separator (or, after the last post, the 3-space tail) following this
    # post starts a new space run unless a space precedes it
    follows = (~is_cut) & ((~pick("empty") & ~pick("trail")) | (pick("empty") & is_first))
    spaces = pick("starts") + pick("runs") + lead + follows.cast("int")
    after = k.groupBy("person_id").agg((F.sum(spaces) + 1).alias("n_after"), F.sum(pick("words")).alias("n_words"))
    return per.select("person_id", "n_before").join(after, "person_id")


def hist_before_after_posts(post_rows: DataFrame, width: int = 50) -> DataFrame:
    """``hist_before_after`` from post rows (no person text is built)."""
    c = person_clean_word_counts(post_rows)
    stacked = c.select(F.explode(F.array(
        F.struct(bucket_of("n_before", width).alias("bucket"), F.lit(1).alias("is_before")),
        F.struct(bucket_of("n_after", width).alias("bucket"), F.lit(0).alias("is_before")))).alias("s")).select("s.*")
    counts = stacked.groupBy("bucket").agg(
        F.count_if(F.col("is_before") == 1).alias("before"),
        F.count_if(F.col("is_before") == 0).alias("after"))
    grid = bucket_grid(post_rows.sparkSession, width)
    return grid.join(F.broadcast(counts), "bucket", "left").select(
        "bucket", "post_length",
        F.coalesce("before", F.lit(0)).cast("bigint").alias("before"),
        F.coalesce("after", F.lit(0)).cast("bigint").alias("after"))
