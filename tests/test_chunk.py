"""Packing rules, including the exact parallel per-group packing against a
plain sequential loop."""

import random

from pyspark.sql import functions as F

from lexis.operators import chunk as K


def _seq_pack(sizes, budget):
    """Reference rule: greedy, trailing bin dropped once anything was flushed."""
    bins, cur, fin = [], [], False
    for i, s in enumerate(sizes):
        if sum(sizes[j] for j in cur) + s <= budget:
            cur.append(i)
        else:
            bins.append(cur)
            cur = [i]
            fin = True
    if not fin:
        bins.append(cur)
    return [(len(b), sum(sizes[j] for j in b), b[0] if b else None) for b in bins]


def _spark_pack(spark, groups, budget, segment_rows):
    rows = [(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "g int, i long, s int")
    out = K.pack_by_group(df, "g", ["i"], "s", budget, segment_rows).collect()
    res = {}
    for r in out:
        res.setdefault(r["g"], []).append((r["n_items"], r["n_tokens"], r["first_i"]))
    return {g: sorted(v, key=lambda t: (-1 if t[2] is None else t[2])) for g, v in res.items()}


def test_pack_literals(spark):
    got = _spark_pack(spark, {1: [600, 400, 100, 900], 2: [100, 200], 3: [1500, 10]}, 1024, 1000)
    assert got[1] == [(2, 1000, 0)]                 # trailing 100+900 dropped
    assert got[2] == [(2, 300, 0)]                  # nothing flushed: kept
    assert got[3] == [(0, 0, None), (1, 1500, 0)]   # empty first row, trailing 10 dropped


def test_pack_parallel_equals_sequential(spark):
    rnd = random.Random(5)
    groups = {g: [rnd.choice([0, 1, 5, 50, 120, 300, 700, 1100]) for _ in range(rnd.randint(1, 60))]
              for g in range(12)}
    groups[99] = [rnd.randint(1, 400) for _ in range(400)]   # a hot group
    want = {g: sorted(_seq_pack(s, 1024), key=lambda t: (-1 if t[2] is None else t[2])) for g, s in groups.items()}
    for seg in (1, 2, 7, 50, 10_000):
        assert _spark_pack(spark, groups, 1024, seg) == want, seg


def test_pack_ids_request_rule(spark):
    df = spark.createDataFrame([([[1] * 1000, [2] * 30, [3] * 5],)], "s array<array<int>>")
    r = df.select(F.transform(K.pack_ids_col("s", 1024, 10), lambda c: F.size(c))).first()[0]
    assert r == [1000, 35]
    df2 = spark.createDataFrame([([[1] * 2000, [2] * 5],)], "s array<array<int>>")
    r2 = df2.select(F.transform(K.pack_ids_col("s", 1024, 10), lambda c: F.size(c))).first()[0]
    assert r2 == [0, 2000]   # first flush is empty; trailing 5 < 10 dropped


def test_pack_words_always_emits_last(spark):
    df = spark.createDataFrame([(["a b. ", "c d. "],), ([],)], "p array<string>")
    r = [x[0] for x in df.select(K.pack_words_col("p", 300)).collect()]
    assert r[0] == ["a b. c d. "]
    assert r[1] == [""]


def test_pad_and_mask(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "t array<int>")
    r = df.select(K.pad_truncate("t", 5).alias("p"), K.pad_truncate("t", 2).alias("c"),
                  K.attention_mask(K.pad_truncate("t", 5)).alias("m")).first()
    assert r["p"] == [5, 6, 7, 0, 0] and r["c"] == [5, 6] and r["m"] == [1, 1, 1, 0, 0]


def _py_pack_words(pieces, budget=300):
    out, sp = [], ""
    for ss in pieces:
        if len(sp.split(" ")) + len(ss.split(" ")) <= budget:
            sp += ss
        else:
            out.append(sp)
            sp = ss
    out.append(sp)
    return out


def _py_pack_ids(seqs, budget=1024, min_last=10):
    cur, out, temp = 0, [], []
    for s in seqs:
        if len(s) + cur <= budget:
            temp = temp + s
            cur += len(s)
        else:
            out.append(temp)
            temp, cur = list(s), len(s)
    if len(temp) >= min_last:
        out.append(temp)
    return out


def test_row_packing_matches_python_loops(spark):
    rnd = random.Random(9)
    words = [" ".join("w" for _ in range(rnd.choice([0, 1, 3, 40, 120, 290, 301, 500]))) + ". "
             for _ in range(200)]
    piece_rows = [([rnd.choice(words) for _ in range(rnd.randint(0, 12))],) for _ in range(60)]
    df = spark.createDataFrame(piece_rows, "p array<string>")
    got = [r[0] for r in df.select(K.pack_words_col("p", 300)).collect()]
    assert got == [_py_pack_words(p) for (p,) in piece_rows]

    id_rows = [([[rnd.randint(1, 9)] * rnd.choice([0, 3, 9, 200, 700, 1024, 1500])
                 for _ in range(rnd.randint(0, 10))],) for _ in range(60)]
    df2 = spark.createDataFrame(id_rows, "s array<array<int>>")
    got2 = [r[0] for r in df2.select(K.pack_ids_col("s", 1024, 10)).collect()]
    assert got2 == [_py_pack_ids(s) for (s,) in id_rows]


def test_pack_hot_groups_on_table(spark):
    """Two groups hold all 60k lineitem rows; 5k-row segments; equals a loop."""
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        "l_linestatus", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("q"))
    got = sorted(tuple(r) for r in K.pack_by_group(li, "l_linestatus", ["l_orderkey", "l_linenumber"], "q",
                                                   1024, 5_000).collect())
    pdf = li.toPandas().sort_values(["l_linestatus", "l_orderkey", "l_linenumber"])
    want = []
    for g, part in pdf.groupby("l_linestatus"):
        sizes, ok, ln = part["q"].tolist(), part["l_orderkey"].tolist(), part["l_linenumber"].tolist()
        for n, tot, first in _seq_pack(sizes, 1024):
            want.append((g, ok[first] if first is not None else None, ln[first] if first is not None else None,
                         n, tot))
    assert got == sorted(want)


def test_person_packing_parallel_equals_row_rule(spark):
    """Next-fit with weight words-1 / budget 298 / trailing kept == the
    300-word rule applied to each person's ordered pieces."""
    from lexis.functions import text as T
    rnd = random.Random(17)
    choices = ["", "a. ", "a b c. ", " ".join(["w"] * 150) + ". ", " ".join(["w"] * 299) + ". ",
               " ".join(["w"] * 400) + ". "]
    rows = [(p, i, rnd.choice(choices)) for p in range(40) for i in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(rows, "person_id long, post_no int, ss string").withColumn("w", T.space_parts("ss") - 1)
    for seg in (3, 1000):
        assigned = K.pack_assign(df, "person_id", ["post_no"], "w", 298, seg)
        bins = assigned.groupBy("person_id", "bin").agg(F.array_join(F.transform(F.array_sort(
            F.collect_list(F.when(F.col("ss") != "", F.struct("post_no", "ss")))), lambda x: x["ss"]), "").alias("c"))
        got = {}
        for r in bins.collect():
            got.setdefault(r["person_id"], []).append((r["bin"], r["c"]))
        for r in assigned.where("pos = 0 AND bin = 1").collect():
            got.setdefault(r["person_id"], []).append((-1, ""))
        got = {p: [c for _, c in sorted(v)] for p, v in got.items()}
        want = {}
        for p in {r[0] for r in rows}:
            want[p] = _py_pack_words([ss for (pp, i, ss) in sorted(rows) if pp == p], 300)
        assert got == want, seg
