"""Quality rules: fixed rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hash buckets of the 1- and 2-grams of words
are estimated: one from trusted documents (the target), one from all documents
(the raw corpus).  Each raw count gets ``smoothing`` pseudo-counts and each
target count the same times the target's share of the n-grams, so an n-gram
seen only a few times says little either way.  A document's score is the sum of the log ratios of its
n-grams divided by (their number + ``shrink``); every document whose score
reaches ``threshold`` is kept.  Log ratios are rounded to integers (millionths)
before they are added, so a score does not depend on the order of addition.

Everything is DataFrame expressions.  Estimation is one pass with map-side
partial sums (at most ``buckets`` rows leave a task); scoring is one projection
over the table, which the ratios (``buckets`` integers) reach as a scalar
subquery.  The text is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import fresh, let, words

BUCKETS = 1 << 18
SMOOTHING = 10.0
SHRINK = 16
THRESHOLD = -0.2
MAX_TRUSTED = 100_000
UNIT = 1_000_000
WINDOW = 5

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"]


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _pairs(h: Column) -> Column:
    """Hashes of neighbouring words, from the word hashes."""
    return F.transform(F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(h, i), x))


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents: quality 1 and not toxic.  The target is fitted
    on a bounded sample of labelled rows: at most ``max_trusted``, those with
    the smallest hash of the id."""
    ids = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, one column ``ratios``: for each bucket the log ratio of target to
    raw probability in millionths (all 0 if there is no trusted text)."""
    mark = F.broadcast(trusted.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_t")))   # at most max_trusted ids
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_x")).join(mark, "_id", "left")
    grams = src.select("_t", F.explode(let(_word_hashes(F.col("_x")), lambda h: F.concat(h, _pairs(h)))).alias("g"))
    counts = grams.groupBy(F.pmod("g", F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("raw"), F.count("_t").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("b")).join(counts, "b", "left").na.fill(0)
    one = every.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("c"),
                    F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    a = F.lit(float(smoothing))
    share = F.col("n_target") / F.greatest(F.col("n_raw"), F.lit(1))
    one = one.withColumn("share", share)
    log = F.transform("c", lambda x: F.round(F.lit(UNIT) * (
        F.log((x["target"] + a * F.col("share")) / (F.col("n_target") + a * F.col("share") * buckets))
        - F.log((x["raw"] + a) / (F.col("n_raw") + a * buckets)))).cast("long"))
    return one.select(F.when(F.col("n_target") > 0, log).otherwise(F.array_repeat(F.lit(0).cast("long"), buckets)).alias("ratios"))


def _repeat_words(h: Column, pairs: Column) -> Column:
    """Number of words inside windows of five words that occur twice or more
    (a window is hashed from two pairs and a word)."""
    windows = F.when(F.size(h) >= WINDOW, F.transform(
        F.slice(h, WINDOW, F.greatest(F.size(h) - WINDOW + 1, F.lit(0))),
        lambda x, i: F.xxhash64(F.get(pairs, i), F.get(pairs, i + 2), x))).otherwise(F.array().cast("array<long>"))

    def covered(w: Column) -> Column:
        in_order = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(in_order, lambda s: let(
            F.sort_array(F.transform(
                F.filter(F.transform(s, lambda x, k: F.struct(
                    x["i"].alias("i"),
                    ((F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"]))
                     ).alias("again"))), lambda x: F.coalesce(x["again"], F.lit(False))),
                lambda x: x["i"])),
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x)))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))


def _row(text: Column, ratios: Column, buckets: int, shrink: int, threshold: float) -> Column:
    """An array of one struct with FIELDS."""
    x = F.coalesce(text, F.lit(""))
    dup = let(F.filter(F.split(x, "\n"), lambda ln: ln.rlike(r"[^\x20\x09-\x0D]")),
              lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    base = F.struct(
        (F.length(x) - F.length(F.regexp_replace(x, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        words(x).alias("w"), ratios.alias("r"))

    def with_base(b: Column) -> Column:
        return let(F.transform(b["w"], lambda w: F.xxhash64(w)), lambda h: let(_pairs(h), lambda p: with_hashes(b, h, p)))

    def with_hashes(b: Column, h: Column, p: Column) -> Column:
        r, zero = b["r"], F.lit(0).cast("long")

        def total(grams: Column) -> Column:
            return F.aggregate(grams, zero, lambda acc, g: acc + F.get(r, F.pmod(g, F.lit(buckets)).cast("int")))
        return let(F.struct(F.size(h).cast("long").alias("n_words"), _repeat_words(h, p).alias("rep"),
                            (F.size(h) + F.size(p)).alias("n"), (total(h) + total(p)).alias("s")), lambda c: verdict(b, c))

    def verdict(b: Column, c: Column) -> Column:
        failed = (c["n_words"] < 10) | (c["rep"] * 100 > c["n_words"] * 20)
        llr = c["s"] / F.lit(float(UNIT)) / (c["n"] + shrink)
        chars = F.length(F.array_join(b["w"], "")).cast("long")
        return F.struct(c["n_words"].alias("n_words"), chars.alias("word_chars"), b["n_symbols"].alias("n_symbols"),
                        b["n_dup_lines"].alias("n_dup_lines"), c["rep"].alias("n_repeat_words"),
                        failed.alias("base_failed"), (~failed & (llr >= threshold)).alias("kept"), llr.alias("llr"))

    return F.transform(F.array(base), lambda b: with_base(b))


def quality(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
            shrink: int = SHRINK, threshold: float = THRESHOLD, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Return ``doc_id`` and FIELDS for every row of ``docs``.

    Null and empty texts have no words and fail the base rules; ids may be null
    or repeat (each row is judged alone); a trusted id that no document has
    counts for nothing; without trusted text nothing but the base rules
    rejects; an empty table gives an empty result; other columns are ignored."""
    r = log_ratios(docs, trusted, buckets, smoothing, id_col, text_col).scalar()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), r.alias("ratios"))
    return src.select("doc_id", F.inline(_row(F.col("text"), F.col("ratios"), buckets, shrink, threshold)))


def keep_good(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    opt = {"buckets": BUCKETS, "smoothing": SMOOTHING, "shrink": SHRINK, "threshold": THRESHOLD,
           "id_col": "doc_id", "text_col": "text"} | options
    r = log_ratios(docs, trusted, opt["buckets"], opt["smoothing"], opt["id_col"], opt["text_col"]).scalar()
    name, ratios = fresh(docs, "_quality"), fresh(docs, "_ratios")
    row = _row(F.col(opt["text_col"]), F.col(ratios), opt["buckets"], opt["shrink"], opt["threshold"])
    judged = docs.select("*", r.alias(ratios)).select("*", F.explode(F.transform(row, lambda x: x["kept"])).alias(name))
    return judged.where(F.col(name)).select(*[F.col(f"`{c}`") for c in docs.columns])
