"""N-gram Jaccard join: groups of documents whose shingle sets nearly agree.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets
of word shingles (words lower-cased A-Z, hashed to 64 bits; the sets are hashed
to 128 bits to find equal ones).  The links come from the sparse product of the
document by shingle incidence matrix with its transpose, in blocks and with
bounds that follow from the set sizes:

* Equal sets are one row of the matrix (a class); copies are never paired.
* Shingles have a global order, rare ones first (a hashed count sketch of fixed
  size, ties by hash).  A set of n needs only its first
  ``n - ceil(percent * n / 100) + 1`` shingles as columns: two sets that link
  share one of these.  Very common shingles thus hardly ever form a column.
* A block of the product is what one shuffle partition holds of the columns.
  A pair is not even formed when its sizes differ too much, or when the
  shingle's places in the two sets leave too few behind it; it goes when the
  overlap of all its columns plus the rest of the sets stays below the overlap
  that the sizes ask for.
* In a first, linear round each class meets only the ``HEADS`` heads of each of
  its columns.  Columns whose classes the links of that round have joined are
  done, so large groups of near copies don't produce all their pairs; in the
  others only classes of different components meet, and classes joined with
  the column's main head meet only those that are not.
* What is left is checked exactly on the whole sets.

Joins are plain joins of stored tables, which adaptive execution can split on
a hot column; counts combine on the map side; components are found by label
passing between stored tables (see ``components``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import Stored, mix64, window_hash, word_slices
from lexis.llm.components import components

SHINGLE_WORDS = 3
PERCENT = 90
SKETCH_BITS = 18
HEADS = 8


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes; fewer words than ``width``: one shingle of all."""
    if len(h) == 0:
        return h
    return np.unique(window_hash(h, min(width, len(h))) if len(h) >= width else mix64(window_hash(h, len(h)), len(h)))


def _sketch(width: int, bits: int):
    """text -> bucket, n: how many sets hold a shingle of the bucket, summed over a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for w in word_slices(b.column(0), lower=True):
                sets = [shingle_set(w.hash[w.at[d]:w.at[d + 1]], width) for d in range(w.n_docs)]
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    return run


def frequency_levels(docs: DataFrame, width: int, bits: int, text_col: str) -> np.ndarray:
    """For each of the 2**bits buckets a level from 0 (rare) upwards: the log2 of
    its count over the mean.  Fixed in size whatever the table's."""
    n = docs.select(text_col).mapInArrow(_sketch(width, bits), "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()           # at most 2**bits rows
    counts = np.zeros(1 << bits)
    counts[n["bucket"].to_numpy()] = n["n"].to_numpy()
    mean = max(counts.mean(), 1.0)
    return np.maximum(np.floor(2 * np.log2(np.maximum(counts, 1) / mean)), 0).astype(np.uint8)


def prefix_length(n, percent: int):
    """Columns that a set of n needs: n - ceil(percent * n / 100) + 1."""
    return n + (-percent * n) // 100 + 1


def _classes(width: int, percent: int, levels: np.ndarray):
    """doc_id, key, text -> doc_id, key, n, f1, f2 (hash of the set), prefix."""
    shift = np.uint64(64 - (len(levels).bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in word_slices(b.column(2), lower=True):          # a batch out for each slice: little is held at once
                n, f1, f2, prefix = [], [], [], []
                for d in range(w.n_docs):
                    s = shingle_set(w.hash[w.at[d]:w.at[d + 1]], width)
                    n.append(len(s))
                    with np.errstate(over="ignore"):
                        f1.append(mix64(s, 11).sum(dtype=np.uint64))
                        f2.append(mix64(s, 12).sum(dtype=np.uint64))
                    lev = levels[(s >> shift).astype(np.int64)]
                    order = np.argsort(lev, kind="stable")            # s is sorted: ties by hash
                    prefix.append(s[order[:prefix_length(len(s), percent) if len(s) else 0]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(w.first, w.n_docs), b.column(1).slice(w.first, w.n_docs), pa.array(n, pa.int32()),
                     pa.array(np.array(f1, np.uint64).view(np.int64)), pa.array(np.array(f2, np.uint64).view(np.int64)),
                     pa.array(prefix, pa.list_(pa.int64()))], ["doc_id", "key", "n", "f1", "f2", "prefix"])
    return run


def _sets(width: int):
    """cid, text -> cid, set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in word_slices(b.column(1), lower=True):
                out = [shingle_set(w.hash[w.at[d]:w.at[d + 1]], width).view(np.int64) for d in range(w.n_docs)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(w.first, w.n_docs), pa.array(out, pa.list_(pa.int64()))], ["cid", "set"])
    return run


def _needed(na: Column, nb: Column, percent: int) -> Column:
    """Smallest overlap with which sets of these sizes link."""
    return F.ceil(F.lit(percent) * (na + nb) / F.lit(100 + percent) - 1e-9)


def _sizes_fit(na: Column, nb: Column, percent: int) -> Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def _enough(count: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether ``count`` shingles in both prefixes leave a link possible: a common
    shingle outside lies behind the prefix of the set whose prefix ends first."""
    rest = F.greatest(*[n - (n + F.floor(-percent * n / 100) + 1) for n in (na, nb)])
    return count + rest >= _needed(na, nb, percent)


class JaccardGroups:
    """Classes of equal sets and their components in ``docs``; see the module's text.

    Null and empty texts, and texts without words, have an empty set and link
    with nothing.  Ids may repeat (each row has its own set) or be null (the
    row counts, but its null is not a smallest id).  An empty table has no groups."""

    def __init__(self, docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS,
                 id_col: str = "doc_id", text_col: str = "text"):
        self.stored, self.width, self.percent = Stored(docs.sparkSession, "jaccard"), width, percent
        id_type = docs.schema[id_col].dataType.simpleString()
        self.src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
        levels = frequency_levels(docs, width, bits, text_col)
        one = self.stored.put(self.src.mapInArrow(
            _classes(width, percent, levels), f"doc_id {id_type}, key long, n int, f1 long, f2 long, prefix array<long>"))
        first = one.where("n > 0").groupBy("f1", "f2").agg(
            F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.min(F.struct("doc_id", "key")).alias("lead"),
            F.min("doc_id").alias("least"))
        self.classes = self.stored.put(first.withColumn("cid", F.monotonically_increasing_id()))   # unique once written
        self.one = self.stored.put(one.drop("prefix"))
        self.stored.drop(one)
        self.stored.let_go()

    # ---- candidates
    def _columns(self) -> tuple[DataFrame, DataFrame]:
        """The entries of columns with two classes or more (t, cid, n, at), and up to
        HEADS heads of each (t, first, first_n, is_main): of every part of its classes
        the one with the fewest rarer shingles, in a group of near copies one near to
        all.  Nearly all columns have one class; they go before anything is stored.
        A class holds a shingle once, so a column's classes are counted without their numbers."""
        several = self.classes.select(F.explode("prefix").alias("_t")).groupBy("_t").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("_t")
        several = self.stored.put(several)
        self.stored.let_go()
        rows = self.classes.select("cid", "n", F.posexplode("prefix").alias("at", "t"))
        cols = self.stored.put(rows.join(several, F.col("t") == F.col("_t")).select("t", "cid", "n", "at"))
        self.stored.drop(several)
        self.stored.let_go()
        part = F.pmod(F.xxhash64("cid"), F.lit(HEADS))
        some = self.stored.put(cols.groupBy("t", part.alias("part")).agg(F.min(F.struct("at", "cid", "n")).alias("lo")))
        main = some.groupBy("t").agg(F.min("lo").alias("lo")).select(F.col("t").alias("_t"), F.col("lo.cid").alias("main"))
        heads = some.join(main, F.col("t") == F.col("_t")).select(
            "t", F.col("lo.cid").alias("first"), F.col("lo.n").alias("first_n"), (F.col("lo.cid") == F.col("main")).alias("is_main"))
        heads = self.stored.put(heads)
        self.stored.drop(some)
        return cols, heads

    def _first_pairs(self, cols: DataFrame, heads: DataFrame) -> DataFrame:
        p = self.percent
        h = heads.select(F.col("t").alias("_t"), "first", "first_n")
        met = cols.join(h, (F.col("t") == F.col("_t")) & (F.col("cid") != F.col("first")) & _sizes_fit(F.col("n"), F.col("first_n"), p))
        met = met.groupBy("first", "cid", "first_n", "n").agg(F.count(F.lit(1)).alias("c"))
        met = met.where(_enough(F.col("c"), F.col("n"), F.col("first_n"), p))
        return met.select(F.least("first", "cid").alias("a"), F.greatest("first", "cid").alias("b")).distinct()

    def _other_pairs(self, cols: DataFrame, heads: DataFrame, lab: DataFrame) -> DataFrame:
        """Pairs of different components in the columns that still hold several; ``cols`` and ``heads`` are gone then."""
        p = self.percent
        own = lab.select(F.col("v").alias("_v"), F.col("c").alias("comp"))
        head = heads.where("is_main").join(own, F.col("first") == F.col("_v"), "left") \
            .select(F.col("t").alias("_t"), F.coalesce("comp", "first").alias("first_comp"))
        head = self.stored.put(head)
        rows = cols.join(own, F.col("cid") == F.col("_v"), "left").withColumn("comp", F.coalesce("comp", "cid")) \
            .join(head, F.col("t") == F.col("_t"))
        rows = self.stored.put(rows.select("t", "cid", "n", "at", "comp", (F.col("comp") == F.col("first_comp")).alias("main")))
        for done in (cols, heads, head):
            self.stored.drop(done)
        self.stored.let_go()
        x = rows.where("NOT main").alias("x")
        y = rows.alias("y")
        xn, yn, xa, ya = F.col("x.n"), F.col("y.n"), F.col("x.at"), F.col("y.at")
        need = _needed(xn, yn, p)
        # the first shingle that two linking sets share has at least need - 1 others behind it in both
        met = x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.comp") != F.col("y.comp"))
                     & (F.col("y.main") | (F.col("x.cid") < F.col("y.cid")))
                     & _sizes_fit(xn, yn, p) & (xa <= xn - need) & (ya <= yn - need))
        met = met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
        # then the overlap of the two whole prefixes
        pre = self.classes.select("cid", "n", "prefix")
        one = pre.select(F.col("cid").alias("_a"), F.col("n").alias("na"), F.col("prefix").alias("pa"))
        two = pre.select(F.col("cid").alias("_b"), F.col("n").alias("nb"), F.col("prefix").alias("pb"))
        met = self.stored.put(met)
        self.stored.drop(rows)
        self.stored.let_go()
        met = met.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
        return met.where(_enough(F.size(F.array_intersect("pa", "pb")), F.col("na"), F.col("nb"), p)).select("a", "b")

    # ---- exact check
    def _links(self, pairs: DataFrame) -> DataFrame:
        pairs = self.stored.put(pairs)
        self.stored.let_go()
        ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        lead = self.classes.join(ids, "cid").select("cid", F.col("lead.doc_id").alias("_d"), F.col("lead.key").alias("_k"))
        texts = self.src.join(lead, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))) \
            .select("cid", "text").dropDuplicates(["cid"])
        sets = self.stored.put(texts.mapInArrow(_sets(self.width), "cid long, set array<long>"))
        self.stored.let_go()                             # of the shuffled texts
        got = pairs.join(sets.select(F.col("cid").alias("_a"), F.col("set").alias("sa")), F.col("a") == F.col("_a")) \
            .join(sets.select(F.col("cid").alias("_b"), F.col("set").alias("sb")), F.col("b") == F.col("_b"))
        both = F.size(F.array_intersect("sa", "sb"))
        linked = both * 100 >= (F.size("sa") + F.size("sb") - both) * self.percent
        links = self.stored.put(got.where(linked).select("a", "b"))
        for done in (pairs, sets):
            self.stored.drop(done)
        self.stored.let_go()
        return links

    def labels(self) -> DataFrame:
        """``v, c`` for the classes that link with another one."""
        cols, heads = self._columns()
        lab = components(self._links(self._first_pairs(cols, heads)), self.stored)
        more = self._links(self._other_pairs(cols, heads, lab))
        if more.limit(1).count() == 0:
            return lab
        # links between components: each pair of components counts once, however many links it has
        at = [lab.select(F.col("v").alias(f"_{x}"), F.col("c").alias(f"c{x}")) for x in "ab"]
        ends = more.join(at[0], F.col("a") == F.col("_a"), "left").join(at[1], F.col("b") == F.col("_b"), "left") \
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct()
        top = components(ends, self.stored).select(F.col("v").alias("_v"), F.col("c").alias("_c"))
        all_v = lab.union(top.select("_v", F.col("_v").alias("c"))).groupBy("v").agg(F.min("c").alias("c"))
        return self.stored.put(all_v.join(top, F.col("c") == F.col("_v"), "left").select("v", F.coalesce("_c", "c").alias("c")))

    def rows(self) -> DataFrame:
        """``doc_id, key, n_shingles, component_id, cid`` for every row of ``docs``
        (cid: the smallest class of the component; null without shingles).  The classes
        are gone then."""
        lab = self.labels()
        cl = self.classes.join(lab, F.col("cid") == F.col("v"), "left").withColumn("c", F.coalesce("c", "cid"))
        cl = self.stored.put(cl.select("f1", "f2", "c", "least"))
        comp = cl.groupBy("c").agg(F.min("least").alias("component_id"))
        cl = self.stored.put(cl.join(comp, "c").select(F.col("f1").alias("_1"), F.col("f2").alias("_2"), "c", "component_id"))
        self.stored.drop(self.classes)
        self.stored.let_go()
        out = self.one.join(cl, (F.col("n") > 0) & (F.col("f1") == F.col("_1")) & (F.col("f2") == F.col("_2")), "left")
        return out.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"),
                          F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                          F.col("c").alias("cid"))


def jaccard_groups(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    return JaccardGroups(docs, **options).rows().select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each component, all columns unchanged: that with the
    smallest id (nulls last), then the smallest hash of the text.  Rows without
    shingles all stay."""
    rows = JaccardGroups(docs, **options).rows()
    none = rows.where("cid IS NULL").select("doc_id", "key").distinct().withColumn("all", F.lit(True))
    best = rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("b"))
    keep = best.select(F.col("b.doc_id").alias("_d"), F.col("b.key").alias("_k"), F.lit(False).alias("_all")) \
        .union(none.select("doc_id", "key", "all"))
    keep = keep.withColumn("_to", F.xxhash64("_d", "_k"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h")).withColumn("_at", F.xxhash64("_id", "_h"))
    # one key for the join and for repeated rows, so that whole rows are shuffled once; ids and hashes are compared
    # by expressions that the planner does not take for further keys
    same = F.coalesce(F.col("_id") == F.col("_d"), F.col("_id").isNull() & F.col("_d").isNull()) & (F.col("_h").bitwiseXOR(F.col("_k")) == 0)
    got = row.join(keep, (F.col("_at") == F.col("_to")) & same)
    many = got.where("_all").select("_row")
    one = got.where("NOT _all").dropDuplicates(["_at", "_id", "_h"]).select("_row")
    return many.union(one).select("_row.*")
