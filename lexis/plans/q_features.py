"""Registered feature queries (FEA-1..5, AGG-8, TOP-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators import features as FT
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.sources import tables as V

TOK = S.W + "{2,}"

_TF_CTE = f"""WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents),
t AS (SELECT doc_id, unnest(toks) AS term FROM x),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
st AS (SELECT term, sum(tf) AS tf, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
voc AS (SELECT st.term, st.tf, st.df FROM st, n WHERE st.df >= n.n * 0.1 AND st.df <= n.n * 0.7
        ORDER BY st.tf DESC, st.term LIMIT 1000)
"""


def _docs(spark, d, by_key=False):
    return V.load(spark, d, "documents", by_key).select("doc_id", "text")


def _tf(spark, d, stop=None):
    return FT.term_counts(FT.tokens_long(_docs(spark, d, True), "doc_id", "text", stop))


@query("term_stats", _TF_CTE + "SELECT term, CAST(tf AS BIGINT) AS tf, df FROM st")
def term_stats(spark, d):
    return FT.term_stats(_tf(spark, d)).select("term", F.col("tf").cast("bigint").alias("tf"), "df")


@query("count_vectors", f"""
WITH x AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{TOK}'),
                                      lambda w: NOT list_contains({S.STOP_LIST_SQL}, w)) AS toks FROM documents),
t AS (SELECT doc_id, unnest(toks) AS term FROM x),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term)
SELECT doc_id, term, tf, dense_rank() OVER (ORDER BY term) - 1 AS term_index FROM tf""")
def count_vectors(spark, d):
    """Count vectors (stop words removed) in long form, term index = alphabetical."""
    return FT.count_vectors_long(_docs(spark, d, True), "doc_id", "text", T.STOP_WORDS) \
        .select("doc_id", "term", "tf", "term_index")


@query("vocab_df_limited", _TF_CTE + "SELECT term, CAST(tf AS BIGINT) AS tf, df FROM voc")
def vocab_df_limited(spark, d):
    n = V.load(spark, d, "documents").count()
    return FT.df_limited_vocabulary(_tf(spark, d), n, 0.1, 0.7, 1000) \
        .select("term", F.col("tf").cast("bigint").alias("tf"), "df")


@query("tfidf_l2", _TF_CTE + """,
w AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * (ln((1 + n.n) / (1 + voc.df)) + 1) AS w
      FROM tf JOIN voc ON tf.term = voc.term, n),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT w.doc_id, w.term, w.tf, round(w.w / nr.norm, 6) AS tfidf FROM w JOIN nr USING (doc_id)""")
def tfidf_l2(spark, d):
    n = V.load(spark, d, "documents").count()
    tf = _tf(spark, d)
    voc = FT.df_limited_vocabulary(tf, n, 0.1, 0.7, 1000)
    return FT.tfidf_long(tf, voc, n).select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


@query("vocab_topk", f"""
WITH x AS (SELECT regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents),
t AS (SELECT unnest(toks) AS term FROM x)
SELECT term, count(*) AS tf FROM t GROUP BY term ORDER BY tf DESC, term LIMIT 20""")
def vocab_topk(spark, d):
    """Top-20 terms by corpus frequency (TakeOrderedAndProject: each task keeps 20)."""
    toks = FT.tokens_long(_docs(spark, d), "doc_id", "text")
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("tf")).orderBy(F.desc("tf"), "term").limit(20)


@query("tfidf_vectors", _TF_CTE + """
SELECT d.doc_id, CAST(count(voc.term) AS INTEGER) AS n_terms, CAST(count(voc.term) > 0 AS DOUBLE) AS sq_norm
FROM documents d LEFT JOIN tf ON tf.doc_id = d.doc_id LEFT JOIN voc ON voc.term = tf.term GROUP BY d.doc_id""")
def tfidf_vectors(spark, d):
    """TF-IDF as Spark ML sparse vectors (CountVectorizerModel x idf x L2)."""
    from pyspark.ml.functions import vector_to_array
    docs = _docs(spark, d)
    n = docs.count()
    voc = FT.df_limited_vocabulary(_tf(spark, d), n, 0.1, 0.7, 1000)
    v = FT.tfidf_vectors(docs, voc, n)
    arr = vector_to_array("features")
    return v.select("doc_id", F.size(F.filter(arr, lambda x: x != 0)).alias("n_terms"),
                    F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))


@query("ngram_features", f"""
WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents),
t AS (SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS a FROM x),
l AS (SELECT doc_id, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c, lead(a, 3) OVER w AS e FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
n AS (SELECT doc_id, count(DISTINCT a || ' ' || b) AS n_2, count(DISTINCT a || ' ' || b || ' ' || c) AS n_3,
             count(DISTINCT a || ' ' || b || ' ' || c || ' ' || e) AS n_4 FROM l GROUP BY doc_id)
SELECT x.doc_id, """ + ", ".join(f"CAST(coalesce(n_{n}, 0) AS INTEGER) AS n_{n}" for n in (2, 3, 4)) + """ FROM x LEFT JOIN n ON n.doc_id = x.doc_id""")
def ngram_features(spark, d):
    """2/3/4-gram presence of each document: how many distinct n-grams are present,
    counted in the row (the networks hash the same sets, see ``features.ngram_presence``)."""
    toks = _docs(spark, d).select("doc_id", T.word_tokens("text").alias("toks"))
    return toks.select("doc_id", *[F.size(FT.ngram_sets("toks", n)).alias(f"n_{n}") for n in (2, 3, 4)])


@query("stopwords_anti_join", f"""
WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents),
t AS (SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS term FROM x),
sw AS (SELECT unnest({S.STOP_LIST_SQL}) AS term)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, term FROM t WHERE term NOT IN (SELECT term FROM sw)""")
def stopwords_anti_join(spark, d):
    """Stop-word removal on token rows as a left-anti join with the stop-word
    table (179 rows: a bounded broadcast)."""
    toks = FT.tokens_long(_docs(spark, d), "doc_id", "text")
    sw = spark.createDataFrame([(w,) for w in T.STOP_WORDS], "term string")
    return toks.join(F.broadcast(sw), "term", "left_anti").select("doc_id", "pos", "term")


@query("count_matrix_shape", f"""
WITH x AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{TOK}'),
                                      lambda w: NOT list_contains({S.STOP_LIST_SQL}, w)) AS toks FROM documents),
t AS (SELECT DISTINCT unnest(toks) AS term FROM x)
SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM t) AS n_terms""")
def count_matrix_shape(spark, d):
    """Shape of the count matrix: documents x vocabulary width (both aggregates)."""
    docs = _docs(spark, d)
    n_terms = FT.tokens_long(docs, "doc_id", "text", T.STOP_WORDS).select("term").distinct() \
        .agg(F.count(F.lit(1)).alias("n_terms"))
    n_rows = docs.agg(F.count(F.lit(1)).alias("n_rows"))
    return n_rows.select("n_rows", n_terms.scalar().alias("n_terms"))
