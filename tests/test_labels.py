from pyspark.sql import functions as F

from lexis.functions import labels as L


def test_codes(spark):
    df = spark.createDataFrame([("INFJ",), ("ENFJ",), ("ESTP",)], "t string")
    rows = df.select("t", *L.bits("t"), L.code_a("t").alias("a"), L.code_b("t").alias("b")).collect()
    got = {r["t"]: (tuple(r[1:5]), r["a"], r["b"]) for r in rows}
    assert got["INFJ"] == ((0, 0, 0, 0), 0, 8)
    assert got["ENFJ"] == ((1, 0, 0, 0), 8, 0)
    assert got["ESTP"] == ((1, 1, 1, 1), 15, 7)


def test_code_b_is_alphabetical_index(spark):
    import itertools
    types = ["".join(p) for p in itertools.product("EI", "NS", "FT", "JP")]
    df = spark.createDataFrame([(t,) for t in types], "t string")
    got = {r[0]: r[1] for r in df.select("t", L.code_b("t")).collect()}
    assert [got[t] for t in sorted(types)] == list(range(16))


def test_decode_roundtrip(spark):
    df = spark.range(16).select(F.col("id").cast("int").alias("c"))
    rows = df.select("c", L.letters_from_code_a("c").alias("l")).collect()
    back = spark.createDataFrame([(r["l"],) for r in rows], "t string").select(L.code_a("t")).collect()
    assert [r[0] for r in back] == list(range(16))


def test_confidence(spark):
    df = spark.createDataFrame([(30.0,), (70.0,)], "s double")
    assert [r[0] for r in df.select(L.confidence("s")).collect()] == [70.0, 70.0]


def test_score_tags_swap_ie(spark):
    df = spark.createDataFrame([(0.8, 0.2, 0.6, 0.4)], "a double, b double, c double, d double")
    cols = L.score_tags("a", "b", "c", "d")
    r = df.select(F.concat(*cols[:4]), *cols[4:]).first()
    assert r[0] == "ESFP"          # I/E tag swapped after thresholding
    assert abs(r[1] - 20.0) < 1e-9  # 100 - 80
