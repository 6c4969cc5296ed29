"""Registered profiling queries (AGG-1..6, ORD-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.operators import clean as C
from lexis.operators import profile as P
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.sources import tables as V


def _grid_sql(width: int) -> str:
    return f"""grid AS (
  SELECT CAST(b AS INTEGER) AS bucket,
         CASE WHEN b < 60 THEN CAST(b * {width} AS VARCHAR) || '-' || CAST(b * {width} + {width} AS VARCHAR)
              ELSE CAST(b * {width} AS VARCHAR) || '+' END AS post_length
  FROM range(61) t(b))"""


def _bucket_sql(n: str, width: int) -> str:
    return f"CAST(least(floor({n} / {width}), 60) AS INTEGER)"


HIST_BEFORE_AFTER_SQL = S.with_(S.POSTS_CTE, _grid_sql(50), f"""
c AS (SELECT person_id, posts, {S.clean_profile('posts')} AS clean FROM posts),
s AS (SELECT {_bucket_sql(S.space_parts('posts'), 50)} AS bucket, 1 AS is_before FROM c
      UNION ALL SELECT {_bucket_sql(S.space_parts('clean'), 50)} AS bucket, 0 AS is_before FROM c),
agg AS (SELECT bucket, count(*) FILTER (WHERE is_before = 1) AS before,
               count(*) FILTER (WHERE is_before = 0) AS after FROM s GROUP BY bucket)""") + """
SELECT g.bucket, g.post_length, CAST(coalesce(a.before, 0) AS BIGINT) AS before,
       CAST(coalesce(a.after, 0) AS BIGINT) AS after
FROM grid g LEFT JOIN agg a ON g.bucket = a.bucket"""


def hist_before_after_df(spark, d):
    """Person word counts before / after the profile clean, bucketed by 50,
    computed from post rows: no person text is joined (see
    ``profile.person_clean_word_counts``); the oracle joins and cleans the
    person texts the reference way."""
    return P.hist_before_after_posts(V.turn_rows(spark, d), 50)


@query("hist_before_after_text", HIST_BEFORE_AFTER_SQL)
def hist_before_after_text(spark, d):
    """The same histogram through the person texts (reference row model)."""
    persons = V.posts(spark, d).select("person_id", "posts",
                                       C.clean_profile_col(F.col("posts")).alias("clean"))
    return P.hist_before_after(persons, "clean", "posts", 50)


query("hist_before_after", HIST_BEFORE_AFTER_SQL)(hist_before_after_df)


@query("hist_person", S.with_(S.POSTS_CTE, _grid_sql(50), f"""
agg AS (SELECT {_bucket_sql(S.space_parts('posts'), 50)} AS bucket, count(*) AS cnt FROM posts GROUP BY 1)""") + """
SELECT g.bucket, g.post_length, CAST(coalesce(a.cnt, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN agg a ON g.bucket = a.bucket""")
def hist_person(spark, d):
    return P.histogram(P.person_word_counts(V.turn_rows(spark, d)), "n_words", 50)


@query("hist_post", S.with_(S.POSTS_CTE, _grid_sql(5), f"""
agg AS (SELECT {_bucket_sql(S.space_parts('post'), 5)} AS bucket, count(*) AS cnt FROM post_rows GROUP BY 1)""") + """
SELECT g.bucket, g.post_length, CAST(coalesce(a.cnt, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN agg a ON g.bucket = a.bucket""")
def hist_post(spark, d):
    from lexis.functions import text as T
    pr = V.split_turns(V.turn_rows(spark, d)).select(T.space_parts("post").alias("n"))
    return P.histogram(pr, "n", 5)


@query("hist_docs", S.with_(_grid_sql(50), f"""
agg AS (SELECT {_bucket_sql(S.space_parts('text'), 50)} AS bucket, count(*) AS cnt FROM documents GROUP BY 1)""") + """
SELECT g.bucket, g.post_length, CAST(coalesce(a.cnt, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN agg a ON g.bucket = a.bucket""")
def hist_docs(spark, d):
    from lexis.functions import text as T
    x = V.load(spark, d, "documents").select(T.space_parts("text").alias("n"))
    return P.histogram(x, "n", 50)


@query("count_by_type", S.with_(S.POSTS_CTE) + "SELECT type, count(posts) AS n FROM posts GROUP BY type")
def count_by_type(spark, d):
    """Persons per class.  A person's joined text is never null, so this counts
    persons: one partial aggregate over the turns, no text is joined."""
    persons = V.load(spark, d, "conversations").groupBy("conv_id").agg(F.lit(1).alias("one"))
    lab = V.axes(spark, d).select(F.col("doc_id").alias("conv_id"), "type")
    return P.count_by_type(persons.join(lab, "conv_id", "left"), "type", "one")


@query("count_by_type_docs", S.with_(S.AXES_CTE) + "SELECT type, count(text) AS n FROM axes GROUP BY type")
def count_by_type_docs(spark, d):
    return P.count_by_type(V.axes(spark, d), "type", "text")


@query("distinct_types", S.with_(S.AXES_CTE) + "SELECT DISTINCT type FROM axes WHERE type IS NOT NULL")
def distinct_types(spark, d):
    return P.distinct_types(V.axes(spark, d))


@query("table_shape", """
SELECT 'documents' AS table_name, count(*) AS n_rows, CAST(5 AS INTEGER) AS n_cols FROM documents
UNION ALL SELECT 'conversations', count(*), CAST(4 AS INTEGER) FROM conversations
UNION ALL SELECT 'labels', count(*), CAST(3 AS INTEGER) FROM labels""")
def table_shape(spark, d):
    parts = [P.table_shape(V.load(spark, d, t), t) for t in ("documents", "conversations", "labels")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("axis_counts", S.with_(S.AXES_CTE) + """
SELECT count(*) FILTER (WHERE substr(type, 1, 1) <> 'E') AS n_I, count(*) FILTER (WHERE substr(type, 1, 1) = 'E') AS n_E,
       count(*) FILTER (WHERE substr(type, 2, 1) <> 'S') AS n_N, count(*) FILTER (WHERE substr(type, 2, 1) = 'S') AS n_S,
       count(*) FILTER (WHERE substr(type, 3, 1) <> 'T') AS n_F, count(*) FILTER (WHERE substr(type, 3, 1) = 'T') AS n_T,
       count(*) FILTER (WHERE substr(type, 4, 1) <> 'P') AS n_J, count(*) FILTER (WHERE substr(type, 4, 1) = 'P') AS n_P
FROM axes""")
def axis_counts(spark, d):
    return P.axis_counts(V.axes(spark, d))


@query("head_tail", """
(SELECT doc_id, n_chars, 'head' AS part FROM documents ORDER BY doc_id LIMIT 5)
UNION ALL (SELECT doc_id, n_chars, 'tail' AS part FROM documents ORDER BY doc_id DESC LIMIT 5)""")
def head_tail(spark, d):
    x = V.load(spark, d, "documents").select("doc_id", "n_chars")
    head = x.orderBy("doc_id").limit(5).withColumn("part", F.lit("head"))
    tail = x.orderBy(F.desc("doc_id")).limit(5).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)
