"""Post-level masked lower-case clean equals cleaning the joined person text."""

import random

from pyspark.sql import functions as F

from lexis.operators import clean as C
from lexis.operators import person as PR

PIECES = ["http://a.b/c", "https://x.y/z", "htt://q.r", "HTTP://U.V", "lol", "", " ", "'", "''", "ok go",
          "see https://t.co/x", "a+b", "x\ny", "\n", "INFP", "intj", "123", "sooo", "...", "end.", "w",
          "https://p.q/r+s", "tail http://m.n"]


def _persons(n=120, seed=21):
    rnd = random.Random(seed)
    rows = []
    for pid in range(n):
        k = rnd.randint(1, 7)
        for j in range(k):
            post = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 3)))
            rows.append((pid, j * 3 + rnd.randint(0, 2), post))   # gaps in post numbers
    return rows


def test_masked_lower_posts_equal_joined_text(spark):
    rows = _persons()
    df = spark.createDataFrame(rows, "person_id long, post_no long, post string")
    got = PR.masked_lower_posts(df).groupBy("person_id").agg(F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("piece_no", "post"))), lambda s: s["post"]), "|||").alias("g"))
    joined = df.groupBy("person_id").agg(F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("post_no", "post"))), lambda s: s["post"]), "|||").alias("t"))
    want = joined.select("person_id", C.clean_mask_lower_col(F.col("t")).alias("w"))
    bad = got.join(want, "person_id", "full").where("NOT (g <=> w)").collect()
    assert not bad, [(r["g"], r["w"]) for r in bad[:3]]


def test_piece_numbers_follow_split(spark):
    rows = [(1, 0, "'start https://a.b"), (1, 1, "xyz"), (1, 2, "more text"), (1, 3, "")]
    df = spark.createDataFrame(rows, "person_id long, post_no long, post string")
    got = [(r["piece_no"], r["post"]) for r in PR.masked_lower_posts(df).orderBy("piece_no").collect()]
    joined = "|||".join(p for _, _, p in rows)
    want = spark.createDataFrame([(joined,)], "t string").select(C.clean_mask_lower_col(F.col("t"))).first()[0]
    assert [p for _, p in got] == want.split("|||")
    assert [n for n, _ in got] == list(range(len(got)))


def test_url_chain_blocks(spark):
    posts = ["x http://a", "b", "c d", "e", "see https://q", "", "done now", "htt://z"]
    df = spark.createDataFrame([(7, i, p) for i, p in enumerate(posts)], "person_id long, post_no long, post string")
    got = [r["block"] for r in PR.post_blocks(df).orderBy("post_no").collect()]
    # post 0 ends inside a URL; post 1 has no whitespace, so the URL runs on;
    # post 2 closes it.  Post 4 opens another, post 5 (empty) keeps it open,
    # post 6 closes it; post 7 is the last post.
    assert got == [0, 0, 0, 1, 2, 2, 2, 3]
