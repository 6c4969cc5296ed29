"""Table loading and the derived views every operator works on.

All views are lazy DataFrames over the Parquet tables; Catalyst prunes the
columns a query does not touch and pushes filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexis.functions import labels as L

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# primary keys of the driver tables
KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id", "events": "event_id",
        "embeddings": "vec_id", "labels": "doc_id", "benchmark": "item_id"}
def load(spark: SparkSession, sf_dir: str, name: str, by_key: bool = False) -> DataFrame:
    """Read a table.  An input with fewer scan splits than cores (small files,
    single row groups) would leave the per-row text work of a whole table in
    a few scan tasks, so it is hash-partitioned on its key over all cores
    (cheap at that size, and joins on the key reuse it).  Large inputs keep
    the scan's own file / row-group parallelism and get no extra shuffle, unless
    ``by_key`` asks for one: rows of a key then lie in one partition, so that what is
    exploded from them is grouped by the key where it is, in partitions whose number
    does not depend on the files (the text is shuffled instead of its tokens)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    key = KEYS.get(name)
    try:
        n = spark.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. a remote session): keep the scan as is
        return df.repartition(key) if by_key else df
    if key and n > 1 and splits < n:
        df = df.repartition(n, key)
    elif by_key:
        df = df.repartition(key)
    return df


def axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a four-letter label built from table facts.

    bit IE = lang is 'en', NS = toxic, FT = quality, JP = n_chars >= 2000.
    Documents without a ``labels`` row count as toxic = quality = 0, so every
    document keeps its row.  ``labels`` is one row per doc: the join is a
    plain equi-join that AQE broadcasts only when its measured size allows.
    """
    d = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    b = [
        (F.col("lang") == "en").cast("int"),
        F.coalesce(F.col("toxic"), F.lit(0)).cast("int"),
        F.coalesce(F.col("quality"), F.lit(0)).cast("int"),
        (F.col("n_chars") >= 2000).cast("int"),
    ]
    return j.select(
        "doc_id", "text",
        b[0].alias("b_ie"), b[1].alias("b_ns"), b[2].alias("b_ft"), b[3].alias("b_jp"),
        L.letters_from_bits(*b).alias("type"),
        L.code_from_bits(*b).alias("code"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per person (conversation): turns joined by ``|||`` in turn order.

    This is the reference's row model (one person = one text).  Only person-
    level operators build it; post-level operators read ``post_rows`` and
    never concatenate.  The per-person group is that person's own turns.
    """
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    g = conv.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]),
            "|||").alias("posts"),
        F.count(F.lit(1)).alias("n_posts"),
    )
    lab = axes(spark, sf_dir).select(F.col("doc_id").alias("conv_id"), "type")
    return g.join(lab, "conv_id", "left").select(
        F.col("conv_id").alias("person_id"), "type", "posts", "n_posts")


def turn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per turn: (person_id, post_no, post), the turn's number and text.  The
    texts of a person joined by ``|||`` are the person's text, so whatever works on
    that text may read these rows; a turn that holds separators is several posts."""
    conv = load(spark, sf_dir, "conversations")
    return conv.select(F.col("conv_id").alias("person_id"), F.col("turn").alias("post_no"), F.col("text").alias("post"))


def split_turns(turns: DataFrame) -> DataFrame:
    """``person_id, post_no, post``: the posts of turns (same columns, ``post_no`` their
    order), equal to ``posexplode(split(posts, '|||'))`` of the joined person text.

    A turn is split in its row.  Separators are found from the left, so up to two
    ``|`` that end a turn and are left over go to the front of the next post; how many,
    and how many posts there are before a turn, comes from one segmented scan over
    small numbers of each turn.  A null text is no post; a person's turn numbers must
    differ."""
    from lexis.operators.scan import Automaton, segmented_scan
    turns = turns.where(F.col("post").isNotNull())
    post, n = F.col("post"), F.length("post")
    head, tail = n - F.length(F.ltrim(post, F.lit("|"))), n - F.length(F.rtrim(post, F.lit("|")))
    inside = F.size(F.split(post, r"\|\|\|", -1)) - 1
    stats = turns.select("person_id", "post_no", n.alias("_n"), head.alias("_head"), tail.alias("_tail"), inside.alias("_in"))
    rows = stats.select("person_id", "post_no", *[
        F.when(F.col("_head") == F.col("_n"), (F.col("_head") + r) % 3).otherwise(F.col("_tail") % 3).alias(f"_to{r}") for r in range(3)], *[
        (F.col("_in") + 1 + F.floor((F.col("_head") + r) / 3) - F.floor(F.col("_head") / 3)).alias(f"_add{r}") for r in range(3)])
    scan = Automaton([f"_to{r}" for r in range(3)], [f"_add{r}" for r in range(3)], "_left", "_before")
    at = segmented_scan(rows, "person_id", ["post_no"], scan, "_ends").select("person_id", "post_no", "_left", "_before", "_ends")
    x = turns.join(at, ["person_id", "post_no"])
    whole = F.concat(F.repeat(F.lit("|"), F.col("_left").cast("int")), "post")
    x = x.select("person_id", "_before", "_ends", F.split(whole, r"\|\|\|", -1).alias("_p"))
    x = x.select("person_id", "_before", "_ends", F.size("_p").alias("_k"), F.posexplode("_p").alias("k", "post"))
    over = (F.col("k") == F.col("_k") - 1) & ~F.col("_ends")
    return x.select("person_id", (F.col("_before") + F.col("k")).alias("post_no"),
                    F.when(over, F.rtrim("post", F.lit("|"))).otherwise(F.col("post")).alias("post"))


def post_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per post: (person_id, post_no, post, type), equal to
    ``posexplode(split(posts, '|||'))`` of the person view without building the
    person's text (see ``split_turns``)."""
    lab = axes(spark, sf_dir).select(F.col("doc_id").alias("person_id"), "type")
    return split_turns(turn_rows(spark, sf_dir)).join(lab, "person_id", "left")


def url_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as text with URLs: ``url || ' ' || html``."""
    p = load(spark, sf_dir, "pages")
    return p.select(F.col("page_id").alias("doc_id"), F.concat_ws(" ", "url", "html").alias("text"))


def tagged_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents whose text carries label words (upper and lower
    case), as forum posts often do: ``type || ' ' || text || ' ' || lower(type)``."""
    a = axes(spark, sf_dir)
    return a.select("doc_id", "type", "code",
                    F.concat_ws(" ", "type", "text", F.lower("type")).alias("text"))


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
