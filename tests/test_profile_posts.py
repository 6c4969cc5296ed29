"""The post-level flagship histogram equals the person-text path."""

from pyspark.sql import functions as F

from conftest import SF01
from lexis.functions import text as T
from lexis.operators import clean as C
from lexis.operators import profile as P
from lexis.sources import tables as V


def _text_path(spark, rows):
    df = spark.createDataFrame(rows, "person_id long, post_no long, post string")
    persons = df.groupBy("person_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("post_no", "post"))), lambda s: s["post"]), "|||").alias("posts"))
    got = persons.select("person_id", T.space_parts("posts").alias("nb"),
                         T.space_parts(C.clean_profile_col(F.col("posts"))).alias("na")).collect()
    return {r["person_id"]: (r["nb"], r["na"]) for r in got}, df


def test_person_counts_edge_cases(spark):
    rows = [
        (1, 0, "Hello there. Visit https://x.y/z now"), (1, 1, "  spaced   out  "), (1, 2, "the end"),
        (2, 0, "we saaay this and"), (2, 1, "never seen"),                  # cut in the middle
        (3, 0, "aaa"), (3, 1, "gone"),                                      # cut at position 0
        (4, 0, ""), (4, 1, ""), (4, 2, "word words"),                       # empty posts
        (5, 0, "line one\n\nline two\tand\t\ttabs \n"), (5, 1, "!!! ??? ..."),
        (6, 5, "only one post with a http://a.b+c link"),
    ]
    want, df = _text_path(spark, rows)
    got = {r["person_id"]: (r["n_before"], r["n_after"]) for r in P.person_clean_word_counts(df).collect()}
    assert got == want


def test_person_counts_on_tables(spark):
    pr = V.turn_rows(spark, SF01)
    a = P.person_clean_word_counts(pr)
    b = V.posts(spark, SF01).select("person_id", T.space_parts("posts").alias("nb"),
                                     T.space_parts(C.clean_profile_col(F.col("posts"))).alias("na"))
    bad = a.join(b, "person_id", "full").where("NOT (n_before <=> nb) OR NOT (n_after <=> na)")
    assert bad.count() == 0
