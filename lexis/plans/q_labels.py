"""Registered label-codec queries (LBL-1..11, JN-2) over the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.sources import tables as V


def _bit_sql(i: int, letter: str) -> str:
    return f"CAST(substr(type, {i + 1}, 1) = '{letter}' AS INTEGER)"


_BITS_SQL = ", ".join(f"{_bit_sql(i, hi)} AS bit_{ax.lower()}" for i, ((lo, hi), ax) in
                      enumerate(zip(L.AXIS_LETTERS, L.AXES)))
_CODE_A = f"CAST({_bit_sql(0, 'E')} * 8 + {_bit_sql(1, 'S')} * 4 + {_bit_sql(2, 'T')} * 2 + {_bit_sql(3, 'P')} AS INTEGER)"
_CODE_B = f"CAST((1 - {_bit_sql(0, 'E')}) * 8 + {_bit_sql(1, 'S')} * 4 + {_bit_sql(2, 'T')} * 2 + {_bit_sql(3, 'P')} AS INTEGER)"


def _letters_sql(code: str) -> str:
    parts = []
    for i, (lo, hi) in enumerate(L.AXIS_LETTERS):
        parts.append(f"CASE WHEN (({code} >> {3 - i}) & 1) = 1 THEN '{hi}' ELSE '{lo}' END")
    return "(" + " || ".join(parts) + ")"


@query("label_bits", S.with_(S.AXES_CTE) + f"SELECT doc_id, type, {_BITS_SQL} FROM axes")
def label_bits(spark, d):
    a = V.axes(spark, d)
    return a.select("doc_id", "type", *[L.bit("type", i).alias(f"bit_{ax.lower()}") for i, ax in enumerate(L.AXES)])


@query("label_code", S.with_(S.AXES_CTE) + f"SELECT doc_id, type, {_CODE_A} AS code_a, {_CODE_B} AS code_b FROM axes")
def label_code(spark, d):
    a = V.axes(spark, d)
    return a.select("doc_id", "type", L.code_a("type").alias("code_a"), L.code_b("type").alias("code_b"))


@query("label_alpha", S.with_(S.AXES_CTE) + """
SELECT doc_id, type, CAST(dense_rank() OVER (ORDER BY type) - 1 AS BIGINT) AS label_alpha FROM axes""")
def label_alpha(spark, d):
    """Alphabetical index of the labels present (label-encoder order).  The
    distinct labels are at most 16 (four two-letter axes), so numbering them
    is a tiny single-partition job, broadcast back to the rows."""
    from pyspark.sql import Window
    a = V.axes(spark, d).select("doc_id", "type")
    dim = a.select("type").distinct().withColumn(
        "label_alpha", (F.row_number().over(Window.orderBy("type")) - 1).cast("bigint"))
    return a.join(F.broadcast(dim), "type", "left").select("doc_id", "type", "label_alpha")


@query("label_decode", S.with_(S.AXES_CTE) + f"""
SELECT doc_id, code,
       CAST((code >> 3) & 1 AS INTEGER) AS bit_ie, CAST((code >> 2) & 1 AS INTEGER) AS bit_ns,
       CAST((code >> 1) & 1 AS INTEGER) AS bit_ft, CAST(code & 1 AS INTEGER) AS bit_jp,
       {_letters_sql('code')} AS letters_a,
       {_letters_sql('((code + 8) % 16)')} AS letters_b
FROM axes""")
def label_decode(spark, d):
    a = V.axes(spark, d)
    return a.select("doc_id", "code", *[L.code_bit("code", i).alias(f"bit_{ax.lower()}") for i, ax in enumerate(L.AXES)],
                    L.letters_from_code_a("code").alias("letters_a"), L.letters_from_code_b("code").alias("letters_b"))


@query("label_flip", S.with_(S.AXES_CTE) + """
SELECT doc_id, code, CAST((code + 8) % 16 AS INTEGER) AS flipped, CAST(15 - code AS INTEGER) AS complement FROM axes""")
def label_flip(spark, d):
    a = V.axes(spark, d)
    return a.select("doc_id", "code", L.flip("code").alias("flipped"), L.complement("code").alias("complement"))


@query("label_onehot", S.with_(S.AXES_CTE) + """
SELECT doc_id, array_to_string([1 - b_ie, b_ie], ',') AS onehot_ie, array_to_string([1 - b_jp, b_jp], ',') AS onehot_jp
FROM axes""")
def label_onehot(spark, d):
    a = V.axes(spark, d)
    return a.select("doc_id", F.array_join(L.onehot2("b_ie").cast("array<string>"), ",").alias("onehot_ie"),
                    F.array_join(L.onehot2("b_jp").cast("array<string>"), ",").alias("onehot_jp"))


@query("label_dim_join", S.with_(S.AXES_CTE, f"""
dim AS (SELECT CAST(c AS INTEGER) AS code, {_letters_sql('c')} AS name FROM range(16) t(c))""") + """
SELECT a.doc_id, a.code, d.name FROM axes a JOIN dim d ON a.code = d.code""")
def label_dim_join(spark, d):
    """Code -> name through the 16-row label dimension (broadcast hash join;
    the dimension has exactly 16 rows by construction)."""
    dim = spark.range(16).select(F.col("id").cast("int").alias("code"),
                                 L.letters_from_code_a(F.col("id").cast("int")).alias("name"))
    a = V.axes(spark, d).select("doc_id", "code")
    return a.join(F.broadcast(dim), "code").select("doc_id", "code", "name")
