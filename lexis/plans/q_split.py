"""Registered split / order queries (SPL-1..6, ORD-1..3, SET-1..2, PAD-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.operators import split as SP
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.sources import tables as V


def _h(key: str, seed) -> str:
    return f"md5(CAST({key} AS VARCHAR) || ':{seed}')"


def _hint(key: str, seed) -> str:
    return f"CAST(('0x' || substr({_h(key, seed)}, 1, 15)) AS BIGINT)"


def _axes(spark, d):
    return V.axes(spark, d).select("doc_id", "code")


@query("split_stratified", S.with_(S.AXES_CTE, S.stratified_sizes_cte("sz", "axes", "code"), f"""
r AS (SELECT doc_id, code, row_number() OVER (PARTITION BY code ORDER BY {_h('doc_id', 1)}, doc_id) - 1 AS rk
      FROM axes)""") + """
SELECT r.doc_id, r.code, CASE WHEN r.rk < sz.n_test THEN 'test' ELSE 'train' END AS split
FROM r JOIN sz ON r.code = sz.code""")
def split_stratified(spark, d):
    return SP.split_stratified(_axes(spark, d), "doc_id", "code", 0.15, 1)


_QUOTA_SQL = S.with_(S.AXES_CTE, f"""
r AS (SELECT doc_id, code, row_number() OVER (PARTITION BY code ORDER BY {_h('doc_id', 1)}, doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY code) AS n FROM axes),
p AS (SELECT doc_id, code, rk < floor(n * 15 / 100) AS picked FROM r),
q AS (SELECT doc_id, code, picked,
             row_number() OVER (ORDER BY CASE WHEN picked THEN 0 ELSE 1 END,
                                CASE WHEN picked THEN {_h('doc_id', '1b')} ELSE {_h('doc_id', 1)} END, doc_id) - 1 AS pos
      FROM p)""")


@query("split_quota_head", _QUOTA_SQL + """
SELECT doc_id, code, pos, CASE WHEN picked THEN 'test' ELSE 'train' END AS split FROM q""")
def split_quota_head(spark, d):
    return SP.split_quota_head(_axes(spark, d), "doc_id", "code", 15, 1).select("doc_id", "code", "pos", "split")


@query("split_batches", _QUOTA_SQL + """,
m AS (SELECT count(*) AS n FROM q)
SELECT doc_id, pos, CAST(floor(pos / 32) AS BIGINT) AS batch_no,
       CASE WHEN floor(pos / 32) < floor(ceil(n / 32) * 3 / 20) THEN 'test' ELSE 'train' END AS split
FROM q, m""")
def split_batches(spark, d):
    q = SP.split_quota_head(_axes(spark, d), "doc_id", "code", 15, 1).select("doc_id", "pos")
    return SP.batch_split(q, "pos").select("doc_id", "pos", "batch_no", "split")


def _overlap_sql(disjoint: bool) -> str:
    cond = "rk >= n - (n // 10 + 1)" if disjoint else "rk < n // 10 + 1"
    return S.with_(S.AXES_CTE, """
r AS (SELECT doc_id, code, row_number() OVER (PARTITION BY code ORDER BY doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY code) AS n FROM axes)""") + f"""
SELECT doc_id, code, 'train' AS part FROM r WHERE rk < n - (n // 10 + 1)
UNION ALL SELECT doc_id, code, 'eval' AS part FROM r WHERE {cond}"""


@query("split_overlap", _overlap_sql(False))
def split_overlap(spark, d):
    return SP.split_overlap(_axes(spark, d), "code", ["doc_id"]).select("doc_id", "code", "part")


@query("split_disjoint", _overlap_sql(True))
def split_disjoint(spark, d):
    return SP.split_overlap(_axes(spark, d), "code", ["doc_id"], disjoint=True).select("doc_id", "code", "part")


@query("bootstrap_exact", f"""
WITH idx AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rw FROM documents),
m AS (SELECT count(*) AS n FROM documents),
dr AS (SELECT d AS draw_no, {_hint('d', 10)} % m.n AS rw, m.n FROM range((SELECT n FROM m)) t(d), m)
SELECT dr.draw_no, idx.doc_id, CASE WHEN dr.draw_no < CAST(floor(0.9 * dr.n) AS BIGINT) THEN 'train' ELSE 'eval' END AS part
FROM dr JOIN idx ON dr.rw = idx.rw""")
def bootstrap_exact(spark, d):
    docs = V.load(spark, d, "documents").select("doc_id")
    return SP.bootstrap_exact(docs, "doc_id", 10, 0.9)


@query("shuffle_seeded", f"""
SELECT doc_id, row_number() OVER (ORDER BY {_h('doc_id', 1)}, doc_id) - 1 AS pos FROM documents""")
def shuffle_seeded(spark, d):
    return SP.shuffle_seeded(V.load(spark, d, "documents").select("doc_id"), "doc_id", 1)


@query("split_positional", """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, pos, CASE WHEN pos < CAST(floor(n * 12175 / 13538) AS BIGINT) THEN 'train' ELSE 'eval' END AS part FROM r""")
def split_positional(spark, d):
    """The fixed 12,175 / 13,538 positional cut, scaled to the table size."""
    from lexis.operators.ranking import global_row_number
    docs = V.load(spark, d, "documents").select("doc_id")
    n = docs.count()
    r = global_row_number(docs, ["doc_id"], "pos")
    return SP.positional_cut(r, "pos", (n * 12175) // 13538).select("doc_id", "pos", "part")


@query("sort_by_length", """
SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS INTEGER) AS n_tokens,
       row_number() OVER (ORDER BY len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')), doc_id) - 1 AS pos
FROM documents""")
def sort_by_length(spark, d):
    from lexis.functions import text as T
    from lexis.operators.ranking import global_row_number
    x = V.load(spark, d, "documents").select("doc_id", F.size(T.word_tokens("text")).alias("n_tokens"))
    return global_row_number(x, ["n_tokens", "doc_id"], "pos")


@query("batch_number", _QUOTA_SQL + """,
x AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS toks FROM documents),
n AS (SELECT q.doc_id, q.pos, CAST(least(coalesce(len(x.toks), 0), 2048) AS INTEGER) AS n_tok
      FROM q LEFT JOIN x ON q.doc_id = x.doc_id)
SELECT CAST(floor(pos / 32) AS BIGINT) AS batch_no, count(*) AS n_rows, max(n_tok) AS padded_len
FROM n GROUP BY 1""")
def batch_number(spark, d):
    """Id sequences cut to 2048 and grouped into batches of 32 by position
    (quota-head order); each batch pads to its longest member."""
    from lexis.functions import text as T
    q = SP.split_quota_head(_axes(spark, d), "doc_id", "code", 15, 1).select("doc_id", "pos")
    x = V.load(spark, d, "documents").select("doc_id", F.least(F.size(T.word_tokens("text")), F.lit(2048))
                                             .cast("int").alias("n_tok"))
    j = q.join(x, "doc_id", "left")
    return j.groupBy(F.floor(F.col("pos") / 32).cast("bigint").alias("batch_no")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("n_tok").alias("padded_len"))
