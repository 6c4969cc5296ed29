"""Substring dedup: words inside long windows that an earlier document has too.

A window is ``window`` consecutive words of one document.  A word goes if a
window over it has the word sequence of a window of a document with a smaller
id.  Repeated windows are found level by level, each of twice the length of the
one before (13, 25, 50 words for a window of 50; 13, 25, 50, 100, 200 for 200):

* At each level a full window names one of the windows of the level's length
  inside it, the one with the smallest hash, so equal full windows name equal
  ones, and only a part of all positions is named (one in twenty at 13 words).
* A name that no other document has is not repeated, and no window that names it
  is; the others alone are extended to twice the length.
* It ends when no candidate survives, or at the full length, where windows are
  compared by 128 bits.

The first level reads all documents; the surviving positions go on as stored
tables of keys and hashes, one for each level.

Documents with equal word sequences are found first by a digest of the whole
sequence: only the one with the smallest id takes part in the levels (it has
every window of the others), the others lose all words that lie in a window.

Hashes shuffle, texts don't, but for one join that fetches the documents that
hold a repeated name of the first level.  Counts per hash are combined on the map side;
joins on a hash are plain joins of two stored tables, whose skewed partitions
adaptive execution splits, so a passage that a third of all documents share is
many tasks' work.  No group is gathered: what a task collects is bounded by
the document it belongs to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import Stored, window_hash, word_slices

WINDOW = 50
#: the first level's length is at least half of this, and no more
SHORTEST = 24
NOTHING = hashlib.sha256(b"").hexdigest()


def sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over every ``width`` consecutive values, by doubling."""
    m, y, k = len(x) - width + 1, x, 1
    if m <= 0:
        return x[:0]
    while 2 * k <= width:
        y = op(y[:-k], y[k:])
        k *= 2
    return op(y[:m], y[width - k:width - k + m])


def lengths(window: int) -> list[int]:
    """The levels' lengths: each is half the next one (rounded up), the last is ``window``."""
    out = [window]
    while out[0] > SHORTEST or len(out) == 1:
        out.insert(0, -(-out[0] // 2))
    return out


def named(h: np.ndarray, window: int, width: int) -> np.ndarray:
    """For each full window the hash of the window of ``width`` words that it names."""
    return sliding(window_hash(h, width), window - width + 1, np.minimum)


def _kept(data: np.ndarray, start: np.ndarray, end: np.ndarray, keep: np.ndarray | None = None) -> str:
    raw = data.tobytes()
    pick = zip(start, end) if keep is None else zip(start[keep], end[keep])
    return hashlib.sha256(b" ".join([raw[a:b] for a, b in pick])).hexdigest()


def _summaries(window: int):
    """doc_id, key, text -> doc_id, key, n_words, sha (of all words), named (at the first level)."""
    width = lengths(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, shas, names = [], [], []
            for w in word_slices(b.column(2)):
                raw = w.data.tobytes()
                for d in range(w.n_docs):
                    i, j = w.at[d], w.at[d + 1]
                    n_words.append(int(j - i))
                    shas.append(hashlib.sha256(b" ".join(raw[w.offsets[d]:w.offsets[d + 1]].split())).hexdigest())
                    names.append(np.unique(named(w.hash[i:j], window, width)).view(np.int64) if j - i >= window else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(shas, pa.string()),
                 pa.array(names, pa.list_(pa.int64()))], ["doc_id", "key", "n_words", "sha", "named"])
    return run


def _extended(window: int):
    """doc_id, key, text, named (repeated at the first level) -> for each full window that
    names one of them: doc_id, key, at (first word), g1 .. (its names at the next levels), a, b (its hash)."""
    first, *middle, _ = lengths(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for w in word_slices(batch.column(2)):
                doc, at, hashes = [], [], [[] for _ in range(len(middle) + 2)]
                for d in range(w.n_docs):
                    h = w.hash[w.at[d]:w.at[d + 1]]
                    alive = np.asarray(lists[w.first + d].values).view(np.uint64)
                    ok = np.flatnonzero(np.isin(named(h, window, first), alive))
                    doc.append(np.full(len(ok), w.first + d))
                    at.append(ok)
                    for out, x in zip(hashes, [*[named(h, window, m) for m in middle], window_hash(h, window), window_hash(h, window, 1)]):
                        out.append(x[ok].view(np.int64))
                rows = pa.array(np.concatenate(doc))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(at).astype(np.int32)),
                     *[pa.array(np.concatenate(x)) for x in hashes]],
                    ["doc_id", "key", "at", *[f"g{i + 1}" for i in range(len(middle))], "a", "b"])
    return run


def _without(window: int, with_text: bool):
    """doc_id, key, text, at (first words of the windows to remove) -> doc_id, key, n_removed, kept_sha256 (, kept)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, shas, texts = [], [], []
            for w in word_slices(b.column(2)):
                for d in range(w.n_docs):
                    i, j = w.at[d], w.at[d + 1]
                    edge = np.zeros(j - i + 1, np.int64)
                    at = np.asarray(b.column(3)[w.first + d].values)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    keep = np.cumsum(edge)[:-1] == 0
                    removed.append(int((~keep).sum()))
                    lo = w.offsets[d]
                    own = w.data[lo:w.offsets[d + 1]]
                    s, e = w.start[i:j] - lo, w.end[i:j] - lo
                    shas.append(_kept(own, s, e, keep))
                    if with_text:
                        raw = own.tobytes()
                        texts.append(b" ".join([raw[x:y] for x, y in zip(s[keep], e[keep])]).decode())
            cols = {"doc_id": b.column(0), "key": b.column(1), "n_removed": pa.array(removed, pa.int64()),
                    "kept_sha256": pa.array(shas, pa.string())}
            if with_text:
                cols["kept"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False) -> DataFrame:
    """Return ``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``
    (and ``kept``, the kept words joined by one space, ``with_text``; null where
    no word was removed).

    Null texts have no words; a text with fewer words than a window loses none;
    a row with a null id has no place in the order: it loses nothing and takes
    nothing from others; rows with the same id don't take from each other; an
    empty table gives an empty result; other columns are ignored."""
    if window < 2:
        raise ValueError("a window needs two words at least")
    stored = Stored(docs.sparkSession, "repeats")
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    one = stored.put(src.mapInArrow(_summaries(window),
                                    f"doc_id {id_type}, key long, n_words long, sha string, named array<long>"))

    # equal word sequences: the smallest id stands for all
    long = one.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    groups = long.groupBy("sha").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead < last")
    groups = stored.put(groups.select(F.col("sha").alias("_sha"), "lead"))
    copies = stored.put(long.select("doc_id", "key", "sha").join(groups, F.col("sha") == F.col("_sha"))
                        .where("doc_id > lead").select("doc_id", "key").distinct())
    lone = long.select("doc_id", "key", "named").join(copies, ["doc_id", "key"], "left_anti")

    def repeated(rows: DataFrame, *by: str) -> DataFrame:
        """The values of ``by`` that two documents have, with the smaller id."""
        found = rows.groupBy(*by).agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("last")).where("lead < last")
        return stored.put(found.select(*[F.col(c).alias(f"_{c}") for c in by], "lead"))

    # first level: names of all documents
    names = stored.put(lone.select("doc_id", "key", F.explode("named").alias("g")))
    alive = names.join(repeated(names, "g"), F.col("g") == F.col("_g")).groupBy("doc_id", "key").agg(F.collect_set("g").alias("named"))
    alive = stored.put(alive)
    texts = src.where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "_d").withColumnRenamed("key", "_k")
    some = texts.join(alive, (F.col("_d") == F.col("doc_id")) & (F.col("_k") == F.col("key"))) \
        .select("doc_id", "key", "text", "named").dropDuplicates(["doc_id", "key"])
    some = stored.put(some)

    # the next levels: full windows whose names were repeated so far
    between = [f"g{i + 1}" for i in range(len(lengths(window)) - 2)]
    full = stored.put(some.mapInArrow(_extended(window), f"doc_id {id_type}, key long, at int, " + "".join(f"{g} long, " for g in between) + "a long, b long"))
    for g in between:
        if full.limit(1).count() == 0:
            break                                          # no candidate survives
        full = stored.put(full.join(repeated(full, g), F.col(g) == F.col(f"_{g}")).drop(g, f"_{g}", "lead"))
    first = repeated(full, "a", "b")
    gone = full.join(first, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where("doc_id > lead") \
        .groupBy("doc_id", "key").agg(F.collect_set("at").alias("at"))
    gone = stored.put(gone).withColumnRenamed("doc_id", "_d").withColumnRenamed("key", "_k")
    cut = some.join(gone, (F.col("doc_id") == F.col("_d")) & (F.col("key") == F.col("_k"))) \
        .select("doc_id", "key", "text", "at") \
        .mapInArrow(_without(window, with_text),
                    f"doc_id {id_type}, key long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
    cut = cut.withColumnsRenamed({"doc_id": "_cd", "key": "_ck"})
    whole = copies.select(F.col("doc_id").alias("_wd"), F.col("key").alias("_wk"), F.lit(True).alias("_all"))

    out = one.drop("named").join(whole, (F.col("doc_id") == F.col("_wd")) & (F.col("key") == F.col("_wk")), "left") \
        .join(cut, (F.col("doc_id") == F.col("_cd")) & (F.col("key") == F.col("_ck")), "left")
    fields = [F.col("doc_id"), F.col("n_words"),
              F.when(F.col("_all"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
              F.when(F.col("_all"), F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    if with_text:
        fields.append(F.when(F.col("_all"), F.lit("")).otherwise(F.col("kept")).alias("kept"))
    return out.select(*fields)
