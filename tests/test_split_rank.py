import random

from pyspark.sql import functions as F

from lexis.operators import ranking as R
from lexis.operators import split as SP


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v int")
    got = {r["id"]: r["row_no"] for r in R.global_row_number(df, ["v", "id"], "row_no", 7).collect()}
    want = {i: n for n, (i, _) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert got == want


def test_group_row_number_hot_group(spark):
    rows = [(i, 0 if i % 3 else 1) for i in range(900)]  # group 0 holds two thirds
    df = spark.createDataFrame(rows, "id long, g int")
    out = R.group_row_number(df, ["g"], ["id"], "rk", 9, count_col="n").collect()
    for g in (0, 1):
        ids = sorted(i for i, gg in rows if gg == g)
        got = sorted((r["id"], r["rk"], r["n"]) for r in out if r["g"] == g)
        assert got == [(i, k, len(ids)) for k, i in enumerate(ids)]


def test_split_overlap_rule(spark):
    df = spark.createDataFrame([(i, 1) for i in range(25)], "id long, c int")
    out = SP.split_overlap(df, "c", ["id"]).collect()
    ev = sorted(r["id"] for r in out if r["part"] == "eval")
    tr = sorted(r["id"] for r in out if r["part"] == "train")
    assert ev == [0, 1, 2] and tr == list(range(22))


def test_batch_split_sizes(spark):
    df = spark.range(8675).select(F.col("id").alias("pos"))
    out = SP.batch_split(df, "pos", 32)
    assert out.agg(F.max("batch_no")).first()[0] + 1 == 272
    assert out.where("split = 'test'").count() == 1280


def test_stratified_sizes(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(400)], "id long, c int")
    out = SP.split_stratified(df, "id", "c", 0.15, 1)
    got = {r["c"]: r["n"] for r in out.where("split = 'test'").groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 15, 1: 15, 2: 15, 3: 15}


def test_bootstrap_exact_size(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"))
    out = SP.bootstrap_exact(df, "doc_id", 10)
    assert out.count() == 200
    assert out.where("part = 'train'").count() == 180


def test_running_aggregates_match_sorted_loop(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randint(-5, 9), rnd.choice([None, rnd.randint(0, 100)])) for i in range(700)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, v int, m int")
    out = R.global_running(df, ["id"], sums={"s": F.col("v")}, maxes={"mx": F.col("m")}, row_col="rn", n_parts=6)
    got = {r["id"]: (r["s"], r["mx"], r["rn"]) for r in out.collect()}
    s, mx = 0, None
    for n, (i, v, m) in enumerate(sorted(rows)):
        s += v
        mx = m if mx is None else (mx if m is None else max(mx, m))
        assert got[i] == (s, mx, n)


def test_stratified_sizes_apportion_exact_total(spark):
    import math
    counts = {0: 7, 1: 13, 2: 40, 3: 1, 4: 55, 5: 2}
    rows = [(i * 10 + c, c) for c, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id long, c int")
    out = SP.split_stratified(df, "id", "c", 0.15, 1)
    got = {r["c"]: r["k"] for r in out.where("split = 'test'").groupBy("c").agg(F.count("*").alias("k")).collect()}
    n = sum(counts.values())
    n_test = math.ceil(0.15 * n)
    n_train = n - n_test
    cont = {c: k * n_train / n for c, k in counts.items()}
    alloc = {c: math.floor(v) for c, v in cont.items()}
    need = n_train - sum(alloc.values())
    for c in sorted(counts, key=lambda c: (-(cont[c] - alloc[c]), c))[:need]:
        alloc[c] += 1
    want = {c: counts[c] - alloc[c] for c in counts if counts[c] - alloc[c] > 0}
    assert got == want and sum(got.values()) == n_test
