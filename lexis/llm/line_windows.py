"""Line dedup: windows of three consecutive lines that occurred before.

A document's lines are split at line feeds; lines without a word don't count
and always stay.  Every three consecutive lines that count are a window.  A
window is a later occurrence if an equal one lies at a smaller (document id,
line); all lines that later occurrences cover are removed, overlaps merged.

Windows shuffle as 128-bit hashes.  The first occurrence of each repeated hash
comes from an aggregation that combines on the map side; the join that finds
the later ones is a plain join of two stored tables, whose skewed partitions
adaptive execution splits, so a passage in a third of all documents is spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import STEP_BYTES, Stored, Words, _hash_words, text_buffers, window_hash

LINES = 3


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every line with a word in consecutive texts."""
    w = Words(0, data, offsets)
    breaks = np.append(np.flatnonzero(data == 10), len(data))
    # a line starts at a text's first byte or behind a line feed, and ends at a line feed or with the text
    start = np.union1d(offsets[:-1], breaks + 1)
    start = start[start < len(data)]
    end = np.minimum(breaks[np.searchsorted(breaks, start)], offsets[np.searchsorted(offsets, start, "right")])
    holds = np.searchsorted(w.start, start) < np.searchsorted(w.start, end)
    start, end = start[holds], end[holds]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def _windows(lines: int):
    """doc_id, key, text -> doc_id, key, at (0-based line that counts), a, b (hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            i, n = 0, len(offsets) - 1
            while i < n:
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STEP_BYTES, "right")) - 1)
                part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                start, end, doc = _lines(part, offs)
                if len(start) >= lines:
                    h = _hash_words(part, start, end)
                    same = doc[:-lines + 1] == doc[lines - 1:] if lines > 1 else np.ones(len(doc), bool)
                    at = np.arange(len(doc)) - np.searchsorted(doc, doc)
                    pick = np.flatnonzero(same)
                    rows = pa.array(doc[pick] + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at[pick].astype(np.int64)),
                         pa.array(window_hash(h, lines)[pick].view(np.int64)),
                         pa.array(window_hash(h, lines, 1)[pick].view(np.int64))], ["doc_id", "key", "at", "a", "b"])
                i = j
    return run


def _counts(line: str) -> bool:
    return bool(line.strip(" \t\n\x0b\x0c\r"))


def without_lines(text: str | None, at, lines: int = LINES) -> str | None:
    """The text without the lines that windows starting at ``at`` cover."""
    if text is None or at is None or len(at) == 0:
        return text
    parts = text.split("\n")
    counted = np.flatnonzero([_counts(p) for p in parts])
    gone = np.zeros(len(parts), bool)
    at = np.asarray(at, np.int64)
    for k in range(lines):
        gone[counted[at + k]] = True
    return "\n".join([p for p, g in zip(parts, gone) if not g])


def later_windows(docs: DataFrame, lines: int = LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, at``: for each document (id, hash of text) the first lines
    of the windows that are later occurrences."""
    stored = Stored(docs.sparkSession, "lines")
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    win = stored.put(src.where("doc_id IS NOT NULL").mapInArrow(_windows(lines), f"doc_id {id_type}, key long, at long, a long, b long"))
    place = F.struct("doc_id", "at")
    first = win.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    first = stored.put(first.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "first"))
    later = win.join(first, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where(place > F.col("first"))
    return stored.put(later.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("at")).alias("at")))


def dedup_lines(docs: DataFrame, lines: int = LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of later occurrences removed from the text column.

    All rows and columns stay; ``n_chars`` becomes the new length where a text
    changed.  Null texts stay null; a text with fewer lines than a window stays
    as it is; a text may become empty.  A row with a null id has no place in
    the order: it neither loses lines nor takes any from others.  Rows with
    equal id and text are one document; rows with equal ids and different texts
    are ordered by line alone.  An empty table gives an empty result."""
    at = later_windows(docs, lines, id_col, text_col).select(
        F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("at").alias("_at"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([without_lines(t, s, lines) for t, s in zip(text, starts)], dtype=object)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"),
                      F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_h"))
    # always a merge join: how much is removed must not decide whether texts are shuffled
    got = row.join(at.hint("merge"), (F.col("_id") == F.col("_d")) & (F.col("_h") == F.col("_k")), "left")
    got = got.withColumn("_new", F.when(F.col("_at").isNull(), F.col("_text")).otherwise(
        cut(F.when(F.col("_at").isNotNull(), F.col("_text")), F.col("_at"))))
    out = []
    for f in docs.schema.fields:
        if f.name == text_col:
            out.append(F.col("_new").alias(f.name))
        elif f.name == "n_chars":
            out.append(F.when(F.col("_at").isNull(), F.col("_row")[f.name]).otherwise(
                F.length("_new").cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col("_row")[f.name].alias(f.name))
    return got.select(*out)


def line_digests(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` for every row: lines with a
    word, how many of them go, and the digest of the text that stays."""
    count = "size(filter(split(coalesce({0}, ''), '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]'))"
    src = docs.select("doc_id", "text", F.expr(count.format("text")).cast("long").alias("n_lines"))
    new = dedup_lines(src, lines)
    return new.select("doc_id", "n_lines", (F.col("n_lines") - F.expr(count.format("text"))).cast("long").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The same in DuckDB SQL (unique ids).
ORACLE = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
counted AS (
  SELECT doc_id, i, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM split
  WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
win AS (
  SELECT doc_id, p, s AS a, lead(s, 1) OVER w AS b, lead(s, 2) OVER w AS c FROM counted
  WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
later AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS k FROM win WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, p + d AS p FROM later, (VALUES (0), (1), (2)) AS t(d) WHERE k > 1),
marked AS (
  SELECT s.doc_id, s.i, s.s, c.p, g.p AS q FROM split s
  LEFT JOIN counted c ON s.doc_id = c.doc_id AND s.i = c.i
  LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.p = g.p)
SELECT doc_id, count(p) AS n_lines, count(q) AS n_removed,
       sha256(coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (WHERE q IS NULL), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
