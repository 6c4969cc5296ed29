"""Generators, packing, padding and masks.

* row generators (posts, sentences) are ``posexplode`` of built-in splits;
* per-document packing (one text -> chunks) is a higher-order ``aggregate``
  inside the row: no shuffle at all;
* per-class packing (all posts of a class, in order, into token budgets) is an
  order-dependent scan over arbitrarily large groups, run exactly and in parallel
  by ``scan.segmented_scan`` with the fill of the open bin as its state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators.scan import Packing, segmented_scan


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# generators
# ---------------------------------------------------------------------------
def explode_posts(df: DataFrame, text_col: str = "posts", keep: tuple[str, ...] = ("person_id",)) -> DataFrame:
    """One row per post: ``posexplode(split(posts, '|||'))``."""
    return df.select(*keep, F.posexplode(F.split(text_col, r"\|\|\|", -1)).alias("post_no", "post"))


def sentence_filter_col(post) -> Column:
    """Sentences of a post (split on '.') with at least 5 words once non-letters
    are spaces; each kept sentence loses one leading space and gets '. '."""
    parts = F.split(_c(post), r"\.", -1)
    ok = F.filter(parts, lambda s: T.word_count_ws(F.regexp_replace(s, T.U + r"[^a-zA-Z\s]", " ")) >= 5)
    return F.array_join(F.transform(ok, lambda s: F.concat(
        F.when(F.startswith(s, F.lit(" ")), F.substring(s, F.lit(2), F.length(s))).otherwise(s), F.lit(". "))), "")


def request_sentences_col(text) -> Column:
    """Split on '.' and append '.' to every piece (the trailing empty one too)."""
    return F.transform(F.split(_c(text), r"\.", -1), lambda s: F.concat(s, F.lit(".")))


# ---------------------------------------------------------------------------
# per-row packing (aggregate inside the row)
# ---------------------------------------------------------------------------
def pack_words_col(pieces, budget: int = 300) -> Column:
    """Pack text pieces in order while the space-split word counts fit the
    budget; on overflow the chunk is emitted and the piece starts a new one.
    The last chunk is always emitted (even empty)."""
    init = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc, p):
        fits = T.space_parts(acc["cur"]) + T.space_parts(p) <= budget
        return F.struct(F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["cur"])).alias("done"),
                        F.when(fits, F.concat(acc["cur"], p)).otherwise(p).alias("cur"))

    return F.aggregate(_c(pieces), init, step, lambda acc: F.array_append(acc["done"], acc["cur"]))


def pack_ids_col(seqs, budget: int = 1024, min_last: int = 10) -> Column:
    """Pack id lists in order into chunks of at most ``budget`` ids (an over-long
    list is not cut; the first chunk may be empty); the trailing chunk is kept
    only with at least ``min_last`` ids."""
    init = F.struct(F.array().cast("array<array<int>>").alias("done"), F.array().cast("array<int>").alias("cur"))

    def step(acc, s):
        fits = F.size(acc["cur"]) + F.size(s) <= budget
        return F.struct(F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["cur"])).alias("done"),
                        F.when(fits, F.concat(acc["cur"], s)).otherwise(s).alias("cur"))

    def fin(acc):
        return F.when(F.size(acc["cur"]) >= min_last, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"])

    return F.aggregate(_c(seqs), init, step, fin)


def pad_truncate(ids, length: int) -> Column:
    """Right-pad with 0 to ``length``, cut when longer."""
    return F.slice(F.concat(_c(ids), F.array_repeat(F.lit(0), length)), 1, length)


def pad_only(ids, length: int) -> Column:
    x = _c(ids)
    return F.concat(x, F.array_repeat(F.lit(0), F.greatest(F.lit(length) - F.size(x), F.lit(0))))


def attention_mask(ids) -> Column:
    return F.transform(_c(ids), lambda t: (t != 0).cast("int"))


# ---------------------------------------------------------------------------
# exact parallel per-group packing
# ---------------------------------------------------------------------------
def pack_assign(items: DataFrame, group_col: str, order: list[str], size_col: str, budget: int = 1024,
                segment_rows: int = 1 << 20, n_parts: int | None = None) -> DataFrame:
    """Greedy order-preserving packing of every group's items into bins of at most
    ``budget``: ``items`` with ``pos`` (place in the group), ``bin`` (both from 0) and
    ``ends`` (the group's last item).

    An over-long item is its own bin; bin 0 is empty when the first item alone
    overflows.  Exact for any group size (see ``scan.segmented_scan``); pass no
    texts in ``items``, join them to the result.  Null sizes count 0."""
    sized = items.withColumn("_size", F.coalesce(F.col(size_col).cast("long"), F.lit(0)))
    return segmented_scan(sized, group_col, order, Packing("_size", budget), "ends", n_parts, segment_rows).drop("_size")


def pack_by_group(items: DataFrame, group_col: str, order: list[str], size_col: str, budget: int = 1024,
                  segment_rows: int = 1 << 20, keep_trailing: bool = False, n_parts: int | None = None) -> DataFrame:
    """One row per kept bin: group, the order columns of its first item
    (``first_<col>``), ``n_items`` and ``n_tokens``.  The last open bin of a group
    that closed one before is dropped unless ``keep_trailing``; an empty bin 0 has no
    first item.  Bins are bounded by the budget, so assembling them is a bounded group-by."""
    assigned = pack_assign(items, group_col, order, size_col, budget, segment_rows, n_parts)
    size = F.coalesce(F.col(size_col).cast("bigint"), F.lit(0))
    empty = (F.col("pos") == 0) & (F.col("bin") == 1)              # the first item left bin 0 empty
    bins = assigned.groupBy(group_col, "bin").agg(
        F.min_by(F.struct(*order), F.col("pos")).alias("_first"), F.count(F.lit(1)).alias("n_items"), F.sum(size).alias("n_tokens"),
        F.max("ends").alias("_ends"), F.max(empty).alias("_empty"))
    own = F.struct(*[F.col("_first")[c].alias(f"first_{c}") for c in order], "n_items", "n_tokens",
                   (~F.col("_ends") | (F.col("bin") == 0) | F.lit(keep_trailing)).alias("_kept"))
    types = {f.name: f.dataType for f in items.schema.fields}
    none = F.struct(*[F.lit(None).cast(types[c]).alias(f"first_{c}") for c in order], F.lit(0).cast("bigint").alias("n_items"),
                    F.lit(0).cast("bigint").alias("n_tokens"), F.lit(True).alias("_kept"))
    rows = bins.select(group_col, F.inline(F.when(F.col("_empty"), F.array(none, own)).otherwise(F.array(own))))
    return rows.where("_kept").drop("_kept")
