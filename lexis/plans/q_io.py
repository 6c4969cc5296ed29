"""Registered source / sink queries (SRC-1..4, SNK-1..3).  Each writes to a
fresh folder below ``spark.checkpoint.dir`` and reads the result back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from lexis.functions import labels as L
from lexis.plans import sqlviews as S
from lexis.plans.q_chunk import _DOC_IDS_CTE, doc_ids
from lexis.plans.q_metrics import _AX_CTE, _F1_SQL, _grid_sql, axis_f1, confusion_long, confusion_wide
from lexis.plans.registry import query
from lexis.session import scratch_path
from lexis.sources import files as FS
from lexis.sources import tables as V


@query("src_posts", S.with_(S.POSTS_CTE) + "SELECT person_id, type, posts FROM posts")
def src_posts(spark, d):
    """Labelled-text CSV (quoted, embedded quotes doubled, multi-line) round trip."""
    path = scratch_path(spark, "posts-csv")
    FS.write_csv(V.posts(spark, d).select("person_id", "type", "posts"), path)
    return FS.read_csv(spark, path, FS.POSTS_SCHEMA)


@query("snk_csv_roundtrip", "SELECT doc_id, text, lang FROM documents")
def snk_csv_roundtrip(spark, d):
    path = scratch_path(spark, "docs-csv")
    FS.write_csv(V.load(spark, d, "documents").select("doc_id", "text", "lang"), path)
    schema = Ty.StructType([Ty.StructField("doc_id", Ty.LongType()), Ty.StructField("text", Ty.StringType()),
                            Ty.StructField("lang", Ty.StringType())])
    return FS.read_csv(spark, path, schema)


@query("src_token_list", _DOC_IDS_CTE.replace("WITH ", "WITH " + S.AXES_CTE.strip() + ",\n", 1) + """
SELECT e.doc_id, CAST((a.code + 8) % 16 AS INTEGER) AS label, CAST(len(e.ids) AS INTEGER) AS n_tokens,
       CAST(list_sum(e.ids) AS BIGINT) AS id_sum
FROM e JOIN axes a ON a.doc_id = e.doc_id""")
def src_token_list(spark, d):
    """Token table written as ``label, "id, id, ..."`` CSV and parsed back."""
    e, _ = doc_ids(spark, d)
    lab = V.axes(spark, d).select("doc_id", L.flip("code").alias("label"))
    t = e.join(lab, "doc_id").select("doc_id", "label", FS.format_token_list("tokens").alias("token"))
    path = scratch_path(spark, "token-csv")
    FS.write_csv(t, path)
    r = FS.read_csv(spark, path, FS.TOKENS_SCHEMA).withColumn("ids", FS.parse_token_list("token"))
    return r.select("doc_id", "label", F.size("ids").alias("n_tokens"),
                    F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@query("src_axis_slice", S.with_(S.AXES_CTE) + """
SELECT doc_id, b_ie AS label, CAST(length(text) AS INTEGER) AS text_len FROM axes""")
def src_axis_slice(spark, d):
    """Per-axis (text, label) table partitioned by axis; reading one axis
    prunes the other three folders."""
    a = V.axes(spark, d)
    parts = [a.select("doc_id", "text", F.col(f"b_{ax.lower()}").alias("label"), F.lit(ax).alias("axis"))
             for ax in L.AXES]
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    path = scratch_path(spark, "axis-tables")
    FS.write_partitioned(allp, path, "axis")
    s = FS.read_slice(spark, path, "axis", "IE")
    return s.select("doc_id", "label", F.length("text").alias("text_len"))


@query("snk_matrix_csv", _AX_CTE + ", g AS (" + _grid_sql("rc", "pred_code", "actual_code") + ")\n"
       + "SELECT row, " + ", ".join(f"CAST(sum(CASE WHEN col = {i} THEN n END) AS BIGINT) AS c{i}" for i in range(16))
       + " FROM g GROUP BY row")
def snk_matrix_csv(spark, d):
    """16 x 16 matrix written header-less (row index as first column) and read back."""
    w = confusion_wide(spark, d)
    path = scratch_path(spark, "matrix-csv")
    FS.write_csv(w, path, header=False)
    schema = Ty.StructType([Ty.StructField("row", Ty.IntegerType())] +
                           [Ty.StructField(f"c{i}", Ty.LongType()) for i in range(16)])
    return FS.read_csv(spark, path, schema, header=False)


@query("snk_report", _AX_CTE + _F1_SQL)
def snk_report(spark, d):
    """Two result tables (prediction matrix and F1 table) written as two
    folders of one report; the F1 table is read back."""
    base = scratch_path(spark, "report")
    confusion_long(spark, d).write.mode("overwrite").parquet(os.path.join(base, "prediction"))
    axis_f1(spark, d).write.mode("overwrite").parquet(os.path.join(base, "f1_scores"))
    return spark.read.parquet(os.path.join(base, "f1_scores"))


@query("snk_report_matrix", _AX_CTE + _grid_sql("rc", "pred_code", "actual_code"))
def snk_report_matrix(spark, d):
    """The prediction matrix of the report, written and read back."""
    path = os.path.join(scratch_path(spark, "report"), "prediction")
    confusion_long(spark, d).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
